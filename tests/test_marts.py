import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from listing_analytics.operators import marts, serve


def test_business_and_bands(spark):
    df = spark.createDataFrame([("Digital Security",), ("Recreational Drugs",), (None,)], "broad_category string")
    assert [r.main_business for r in marts.relabel(marts.main_business(df)).collect()] == ["Data", "Drugs", "Other"]
    prices = [-1.0, 0.0, 49.99, 50.0, 200.0, math.inf, math.nan, None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prices)], "i int, price_usd double")
    got = [r.band_order for r in marts.price_band(df).orderBy("i").collect()]
    assert got == [None, 0, 0, 1, 2, None, None, None]


def test_empty_band_stays(spark):
    df = spark.createDataFrame([(10.0,), (300.0,)], "price_usd double")
    assert [(r.price_range, r.n) for r in marts.band_counts(df).collect()] == [
        ("Budget (<= $50)", 1), ("Mid-range ($50-$200)", 0), ("High-end (>$200)", 1)]


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (None,)], "x double")
    assert [r.n for r in marts.histogram(df, "x", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 2]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    counts, edges = np.histogram([3.0, 3.0], 4)
    rows = marts.histogram(same, "x", 4).orderBy("bin").collect()
    assert [r.n for r in rows] == list(counts) and np.allclose([r.bin_from for r in rows], edges[:-1])


def test_histogram_is_numpy(spark):
    values = np.random.default_rng(1).gamma(2.0, 50.0, 400)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert [r.n for r in marts.histogram(df, "x", 30).orderBy("bin").collect()] == list(np.histogram(values, 30)[0])


@pytest.mark.parametrize("kind", ["normal", "outlier", "two", "copies"])
def test_density(spark, kind):
    rng = np.random.default_rng(2)
    values = {"normal": rng.normal(10, 3, 150), "outlier": np.r_[rng.normal(10, 3, 400), 5e4, -3e3], "two": np.array([1.0, 2.0]),
              "copies": np.r_[np.full(300, 7.0), rng.gamma(2.0, 50.0, 200)]}[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    rows = marts.density(df, "x", 50).orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 50)
    brute = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.allclose([r.x for r in rows], grid) and np.abs(np.array([r.density for r in rows]) - brute).max() < 1e-14 / h


def test_density_of_one_value_is_empty(spark):
    assert marts.density(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x").collect() == []
    assert marts.density(spark.createDataFrame([], "x double"), "x").collect() == []


def test_terms_use_default_stop_words(spark):
    df = spark.createDataFrame([("The seller and the best SELLER",), (None,)], "t string")
    assert [(r.term, r.n) for r in marts.term_counts(df, "t").collect()] == [("seller", 2), ("best", 1)]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), (F.col("id") % 17).alias("v"))
    top = marts.top_k_per_group(df, "g", "v", 3, share="share")
    assert top.count() == 6
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def pairs(spark):
    listings = spark.createDataFrame([("v", "n", "Data"), (None, "n", "Data"), ("v", "n", "Drugs")], "vendor string, name string, main_business string")
    reviews = spark.createDataFrame([("v", "n", "positive"), (None, "n", "negative"), ("v", "z", "positive"), ("v", "n", None)],
                                    "vendor string, product string, rating string")
    return listings, reviews


def test_null_vendors_match(spark):
    listings, reviews = pairs(spark)
    only = serve.listing_reviews(listings.filter("main_business = 'Data'"), reviews.filter("rating is not null"))
    assert only.count() == 2


def test_matrix_equals_counting_the_join(spark):
    listings, reviews = pairs(spark)
    many = listings.unionByName(listings).unionByName(listings)
    direct = serve.listing_reviews(many, reviews).filter("rating is not null").groupBy("main_business").pivot(
        "rating", ["positive", "negative"]).count().na.fill(0)
    matrix = serve.review_matrix(many, reviews)
    assert {tuple(r) for r in matrix.collect()} == {tuple(r) for r in direct.collect()}
    long = serve.review_long(matrix, "negative").collect()
    assert {(r.main_business, r.n) for r in long} == {("Data", 3), ("Drugs", 0)}


def test_lookups(spark):
    df = spark.createDataFrame([("a", "Data", 5.0, 0), ("b", "Data", 50.0, 1), ("c", None, 500.0, 2)],
                               "name string, broad_category string, price_usd double, row_ord int")
    assert [r.name for r in serve.find_listings(df).collect()] == ["a", "b", "c"]
    assert [r.name for r in serve.find_listings(df, "Data", (1.0, 2.0)).collect()] == ["b"]
    ticks = serve.log_ticks(spark.createDataFrame([(0,), (99,)], "n long"), "n", shift=1).collect()
    assert [round(r.tick, 6) for r in ticks] == [0.0, 0.5, 1.0, 1.5, 2.0] and [r.label for r in ticks][:2] == [1, 3]
    grouped = spark.createDataFrame([("Data", "x", "low", 3), ("Data", "y", "low", 0), ("Drugs", "z", "low", 1)],
                                    "main_business string, category string, price_range string, product_count long")
    assert [tuple(r) for r in serve.drill_down(grouped, "Data/x").collect()] == [("x", 3)]
    assert {tuple(r) for r in serve.drill_down(grouped, None).collect()} == {("Data", 3), ("Drugs", 1)}
    texts = spark.createDataFrame([("x", "about x")], "category string, description string")
    assert {r.category: r.description for r in serve.describe(grouped, texts).collect()} == {
        "x": "about x", "y": "No specific information available for this category.",
        "z": "No specific information available for this category."}


def test_overlap_of_vendors(spark):
    rows = [("a", "Digital Security"), ("a", "Recreational Drugs"), ("b", "Digital Security"), (None, "Recreational Drugs"), ("c", None)]
    df = marts.main_business(spark.createDataFrame(rows, "vendor string, broad_category string"))
    shares = marts.overlap_share(marts.activity_flags(df))
    assert tuple(shares.first()) == (2, 1, 1, 50.0, 100.0)
    lines = {r.key: r.statement for r in marts.statements(shares, "data", "drug").collect()}
    assert lines["share of data vendors"] == "50.00% of the vendors of data products sell drug products, too"
    assert lines["drug vendors"] == "1 vendors mainly sell drug products"
    summary = {r.main_business: (r.n_vendors, r.side_count) for r in serve.business_summary(df).collect()}
    assert summary == {"Data": (2, 1), "Drug": (1, 1), "Other": (1, None)}


def test_lookups_in_a_mart_open_the_files_of_one_category(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").alias("row_ord"), F.when(F.col("id") % 5 < 4, F.concat(F.lit("0"), F.col("id") % 5)).alias("broad_category"),
        (F.col("id") * 37 % 4000 + 1).cast("double").alias("price_usd"))
    path = str(tmp_path / "mart")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        serve.write_mart(rows, path, "broad_category", "price_usd")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = serve.read_mart(spark, path, rows.schema, "broad_category", None)
    assert whole.count() == 4000 and whole.filter("broad_category is null").count() == 800
    for category, n in (("02", 800), ("2", 0), ("none", 0)):
        one = serve.read_mart(spark, path, rows.schema, "broad_category", category)
        assert one.count() == n and (n or one.isEmpty())
        found = serve.find_listings(one, category, (2.0, 2.5), 5, ["price_usd"])
        plain = serve.find_listings(rows, category, (2.0, 2.5), 5, ["price_usd"])
        assert found.collect() == plain.collect()
        spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
        plan = serve.find_listings(one, category, (2.0, 2.5), 5, ["price_usd"])._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        assert "GreaterThanOrEqual(price_usd" in plan.split("PushedFilters: [")[1].split("]")[0]
        assert f"= {category})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < files(serve.read_mart(spark, path, rows.schema, "broad_category", "02")) < files(whole)
