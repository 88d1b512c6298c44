"""Queries over the cleaning operators (E) and the category steps without a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.functions import text as tx
from listing_analytics.operators import classify, clean
from listing_analytics.plans import roles
from listing_analytics.plans.registry import query
from listing_analytics.plans.roles import LISTING_SQL, REVIEW_SQL, VENDOR_SQL, table
from listing_analytics.session import store


@query("E1_normalise_nulls", """
  select l_orderkey, l_linenumber, case l_returnflag when 'A' then 'A' end as flag,
         case when l_tax > 0.04 then l_tax end as tax from lineitem""")
def e1(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(flag == "N", "NA").when(flag == "R", "").otherwise(flag).alias("flag"),
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")).otherwise(float("nan")).alias("tax"))
    return clean.normalise_nulls(raw)


@query("E2_dedup_keep_first", """
  select * from part qualify row_number() over (partition by p_name order by p_partkey) = 1""")
def e2(spark, sf):
    return clean.dedup_keep_first(table(spark, sf, "part"), ["p_name"], ["p_partkey"])


@query("E3_union_sites", f"with {LISTING_SQL} select * from listing")
def e3(spark, sf):
    rows = roles.listing(spark, sf)
    home = F.col("marketplace") == "ASIA"
    return clean.union_sites(rows.filter(home), rows.filter(~home))


@query("E4_project", "select c_name as name, c_mktsegment as about_text from customer")
def e4(spark, sf):
    return clean.project(table(spark, sf, "customer"), {"c_name": "name", "c_mktsegment": "about_text"})


_USD_SQL = """case when currency = 'USD' then paid else cast(round(cast(
      cast(paid as decimal(19, 4)) * cast(1.08::double / case trim(currency) when 'USD' then 1.08::double
        when 'CAD' then 1.47::double when 'EUR' then 1.0::double when 'GBP' then 0.86::double end
      as decimal(19, 12)) as decimal(38, 10)), 2) as double) end"""


@query("E5_to_usd", f"""
  with {REVIEW_SQL}, p as (select *, cast(regexp_extract(price_paid, '([0-9]+)', 1) as double) as paid from review)
  select vendor, product, currency, paid, {_USD_SQL} as paid_usd from p""")
def e5(spark, sf):
    paid = roles.review(spark, sf).withColumn("paid", tx.first_integer(F.col("price_paid")))
    return clean.to_usd(paid, "paid", "currency", roles.rates(spark), "paid_usd").select(
        "vendor", "product", "currency", "paid", "paid_usd")


@query("E5_unknown_currency", f"with {REVIEW_SQL} select currency, count(*) as n from review "
       "where currency = 'XMR' group by 1")
def e5_rejects(spark, sf):
    paid = roles.review(spark, sf).withColumn("paid", tx.first_integer(F.col("price_paid")))
    converted = clean.to_usd(paid, "paid", "currency", roles.rates(spark), "paid_usd")
    return clean.unknown_currency(converted, "paid", "currency", "paid_usd")


@query("E6_fill", f"""
  with {REVIEW_SQL} select c_name as name, coalesce(n, 0) as review_count
  from customer left join (select vendor, count(*) as n from review group by 1) on vendor = c_name""")
def e6(spark, sf):
    counts = roles.review(spark, sf).groupBy("vendor").agg(F.count(F.lit(1)).alias("review_count"))
    people = table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    joined = people.join(counts, F.col("name") == F.col("vendor"), "left").select("name", "review_count")
    return clean.fill(joined, {"review_count": 0})


@query("E7_last_number", """
  select o_orderkey, case o_orderstatus when 'F' then o_custkey when 'O' then o_orderkey end as last_number
  from orders""")
def e7(spark, sf):
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    raw = (F.when(status == "F", F.col("o_custkey").cast("string"))
           .when(status == "O", F.concat(F.col("o_custkey").cast("string"), F.lit(" | "), key)).otherwise("n|a"))
    return table(spark, sf, "orders").select("o_orderkey", tx.last_number(raw).alias("last_number"))


@query("E8_safe_cast", """
  select c_custkey, try_cast(substr(c_name, 10) as bigint) as as_long, try_cast(c_mktsegment as double) as as_double
  from customer""")
def e8(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", clean.safe_cast(F.substring("c_name", 10, 100), "bigint").alias("as_long"),
        clean.safe_cast(F.col("c_mktsegment"), "double").alias("as_double"))


@query("E9_min_max", f"""
  with {VENDOR_SQL}, b as (select min(review_count) as lo, max(review_count) as hi from vendors)
  select name, review_count,
         (cast(review_count as double) - lo) / nullif(cast(hi as double) - cast(lo as double), 0) as review_count_normalized
  from vendors, b""")
def e9(spark, sf):
    scaled = clean.min_max(roles.vendor(spark, sf), "review_count", "review_count_normalized")
    return scaled.select("name", "review_count", "review_count_normalized")


@query("E10_blank_placeholder", """
  select c_custkey, case when c_mktsegment = 'HOUSEHOLD' then '' else c_mktsegment end as about_text from customer""")
def e10(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", tx.blank_placeholder(F.col("c_mktsegment"), "HOUSEHOLD").alias("about_text"))


@query("E11_star_to_sentiment", """
  select event_id, case when cast(substr(cast(cast(floor(value) as bigint) as varchar), 1, 1) as int) < 3
                        then 'negative' else 'positive' end as rating from events""")
def e11(spark, sf):
    stars = F.concat(F.lit(" "), F.floor("value").cast("bigint").cast("string"), F.lit(" stars"))
    return table(spark, sf, "events").select("event_id", tx.star_to_sentiment(stars).alias("rating"))


@query("E12_first_integer", """
  select event_id, try_cast(nullif(regexp_extract(props, '([0-9]+)', 1), '') as double) as k,
         cast(null as double) as none from events""")
def e12(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", tx.first_integer(F.col("props")).alias("k"), tx.first_integer(F.col("event_type")).alias("none"))


@query("E13_all_digits", """
  select event_id, coalesce(try_cast(nullif(regexp_replace(cast(event_id as varchar) || props, '[^0-9]', '', 'g'), '')
         as bigint), 0) as digits, cast(0 as bigint) as none from events""")
def e13(spark, sf):
    both = F.concat(F.col("event_id").cast("string"), F.col("props"))
    return table(spark, sf, "events").select(
        "event_id", tx.all_digits(both).alias("digits"), tx.all_digits(F.col("event_type")).alias("none"))


@query("E14_split_helpers", """
  select o_orderkey, split_part(o_orderpriority, '-', 1) as first_part, cast(o_custkey as varchar) as number_word,
         len(string_split(o_orderpriority, ' ')) as n_words, trim(o_orderpriority) as stripped from orders""")
def e14(spark, sf):
    priority = F.col("o_orderpriority")
    sentence = F.concat(F.lit(" has "), F.col("o_custkey").cast("string"), F.lit(" of 7 "))
    return table(spark, sf, "orders").select(
        "o_orderkey", tx.split_first(priority, "-").alias("first_part"),
        tx.first_number_word(sentence).alias("number_word"),
        F.size(tx.words(priority)).cast("bigint").alias("n_words"),
        tx.strip(F.concat(F.lit("\t "), priority, F.lit(" \n"))).alias("stripped"))


@query("F1_title_case", r"""
  select l_orderkey, l_linenumber, array_to_string(list_transform(
      regexp_extract_all(lower(p_type || ' ids/dls e-books 2c-b ' || p_name), '([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)'),
      lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), '') as title
  from lineitem join part on l_partkey = p_partkey""")
def f1(spark, sf):
    dirty = F.concat(F.lit("  "), F.col("p_type"), F.lit(" IDs/DLs E-BOOKS 2c-b "), F.col("p_name"), F.lit("\t"))
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select("l_orderkey", "l_linenumber", tx.title_case(dirty).alias("title"))


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Category dictionary over the part types; ECONOMY stays unknown on purpose."""
    kind = F.col("p_type")
    value = (F.when(kind.isin(*roles.GROUPS["Digital"]), "Digital")
             .when(kind.isin(*roles.GROUPS["Physical"]), "Physical"))
    known = table(spark, sf, "part").select(kind.alias("key"), value.alias("value")).distinct()
    return known.filter("value is not null")


_MAPPED_SQL = f"""{LISTING_SQL}, mapped as (
  select name, category, vendor, price_usd, case when main_business = 'Other' then null else main_business end as broad
  from listing)"""


@query("F2_map_category", f"with {_MAPPED_SQL} select name, category, vendor, price_usd, broad as broad_category from mapped")
def f2(spark, sf):
    rows = roles.listing(spark, sf).drop("broad_category").withColumn(
        "category", F.concat(F.lit(" "), F.lower("category"), F.lit(" ")))
    mapped = classify.map_category(rows, _dictionary(spark, sf))
    return mapped.select("name", F.upper(tx.strip(F.col("category"))).alias("category"), "vendor", "price_usd",
                         "broad_category")


@query("F3_listing_text", """
  select p_partkey, coalesce(p_name || ' ' || case when p_size > 25 then p_brand end, 'No description available') as text
  from part""")
def f3(spark, sf):
    brand = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", tx.listing_text(F.col("p_name"), brand).alias("text"))


@query("F4_split_labelled", f"""
  with {_MAPPED_SQL} select name, vendor, price_usd, broad is not null as labelled, broad as broad_category from mapped""")
def f4(spark, sf):
    mapped = store(classify.map_category(roles.listing(spark, sf).drop("broad_category"), _dictionary(spark, sf)), "mapped")
    known, unknown = classify.split_labelled(mapped)
    row = lambda df, flag: df.select("name", "vendor", "price_usd", F.lit(flag).alias("labelled"), "broad_category")
    return row(known, True).unionByName(row(unknown, False))
