import math

from pyspark.sql import functions as F

from listing_analytics import schemas
from listing_analytics.operators import clean


def rates(spark):
    return spark.createDataFrame([("CAD", 1.47), ("USD", 1.08)], schemas.FX_RATES)


def test_nulls(spark):
    df = spark.createDataFrame([("", math.nan), ("NA", 1.0), ("None", 2.0), ("x", None)], "a string, b double")
    rows = [tuple(r) for r in clean.normalise_nulls(df).collect()]
    assert rows == [(None, None), (None, 1.0), (None, 2.0), ("x", None)]


def test_keep_first_groups_nulls(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3), ("a", 4)], "name string, row_ord int")
    rows = {tuple(r) for r in clean.dedup_keep_first(df, ["name"], ["row_ord"]).collect()}
    assert rows == {(None, 1), ("a", 3)}


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("name"), F.col("id").alias("row_ord"))
    plan = clean.dedup_keep_first(df, ["name"], ["row_ord"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") or plan.count("WindowGroupLimit") == 2


def test_to_usd(spark):
    df = spark.createDataFrame([("10.005", "USD"), ("100", "CAD "), ("5", "XMR"), (None, "CAD")], "p string, c string")
    done = clean.to_usd(df, "p", "c", rates(spark))
    got = {(r.p, r.c): r.price_usd for r in done.collect()}
    assert got == {("10.005", "USD"): 10.005, ("100", "CAD "): 73.47, ("5", "XMR"): None, (None, "CAD"): None}
    assert [tuple(r) for r in clean.unknown_currency(done, "p", "c").collect()] == [("XMR", 1)]


def test_to_usd_of_small_and_large_amounts(spark):
    df = spark.createDataFrame([("0.00004", "CAD"), ("1e15", "CAD"), ("1e30", "CAD"), ("0.0123", "CAD ")], "p string, c string")
    done = clean.to_usd(df, "p", "c", rates(spark))
    got = {r.p: r.price_usd for r in done.collect()}
    assert got["0.00004"] == 0.0 and got["0.0123"] == 0.01
    assert abs(got["1e15"] / (1e15 * 1.08 / 1.47) - 1) < 1e-9 and abs(got["1e30"] / (1e30 * 1.08 / 1.47) - 1) < 1e-9
    assert clean.unknown_currency(done, "p", "c").count() == 0


def test_min_max(spark):
    scaled = lambda vs: [r.s for r in clean.min_max(spark.createDataFrame([(v,) for v in vs], "v long"), "v", "s").collect()]
    assert scaled([0, 5, 10]) == [0.0, 0.5, 1.0]
    assert scaled([3, 3]) == [None, None]


def test_no_cross_join_in_min_max(spark):
    df = spark.range(10).withColumnRenamed("id", "v")
    plan = clean.min_max(df, "v", "s")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def raw(spark, schema, rows):
    full = [tuple(r.get(n) for n in schema.fieldNames()) + ("f", i) for i, r in enumerate(rows)]
    ddl = ", ".join(f"{n} string" for n in schema.fieldNames()) + ", source_file string, row_ord long"
    return spark.createDataFrame(full, ddl)


def test_whole_cleaning(spark):
    one = raw(spark, schemas.PRODUCT, [
        dict(name="a", price="10", currency="USD", vendor="v", marketplace="N"),
        dict(name="a", price="99", currency="USD", vendor="w", marketplace="N")])
    two = raw(spark, schemas.PRODUCT, [dict(name="a", price="100", currency="CAD ", vendor="NA", marketplace="W")])
    rows = sorted(tuple(r) for r in clean.clean_products([one, two], rates(spark)).select("name", "price_usd", "marketplace").collect())
    assert rows == [("a", 10.0, "N"), ("a", 73.47, "W")]

    vendors = raw(spark, schemas.VENDOR, [
        dict(name="v", about_text="User hasn't filled in this info", review_count="3|45", marketplace="N"),
        dict(name="w", about_text="hi", review_count="", marketplace="N")])
    got = {r.name: (r.about_text, r.review_count, r.review_count_normalized) for r in clean.clean_vendors([vendors]).collect()}
    assert got == {"v": ("", 45, 1.0), "w": ("hi", 0, 0.0)}

    words = raw(spark, schemas.REVIEW, [dict(vendor="v", rating="positive", price_paid="12.50", currency="CAD")])
    stars = raw(spark, schemas.REVIEW, [dict(vendor="w", rating="2 stars", price_paid="1,234", currency="USD")])
    got = {(r.vendor, r.rating, r.price_paid_usd) for r in clean.clean_reviews(words, stars, rates(spark)).collect()}
    assert got == {("v", "positive", 8.82), ("w", "negative", 1.0)}
