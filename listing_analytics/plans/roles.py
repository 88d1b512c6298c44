"""The order tables seen as listings (odd line numbers), reviews (even ones) and vendors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUPS = {"Digital": ["PROMO", "STANDARD"], "Physical": ["SMALL", "MEDIUM", "LARGE"]}
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
BANDS = [("low", 0.0, 500.0), ("middle", 500.0, 2000.0), ("high", 2000.0, float("inf"))]
RATES = [("USD", 1.08), ("CAD", 1.47), ("EUR", 1.0), ("GBP", 0.86)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, rest: int) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    line = t("lineitem").filter(F.col("l_linenumber") % 2 == rest)
    return (line.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")))


def listing(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """The listings; ``more`` are further columns over the order tables."""
    kind = F.col("p_type")
    return _lines(spark, sf_dir, 1).select(
        F.col("p_name").alias("name"), kind.alias("category"), kind.alias("broad_category"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_usd"),
        F.col("c_name").alias("vendor"), F.col("r_name").alias("marketplace"),
        F.when(kind.isin(*GROUPS["Digital"]), "Digital").when(kind.isin(*GROUPS["Physical"]), "Physical")
        .otherwise("Other").alias("main_business"), *more)


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.when(F.col("l_returnflag") == "A", "positive").when(F.col("l_returnflag") == "R", "negative")
    currency = (F.when(F.col("n_regionkey") == 0, "USD").when(F.col("n_regionkey") == 1, "CAD ")
                .when(F.col("n_regionkey") == 2, "EUR").when(F.col("n_regionkey") == 3, "GBP").otherwise("XMR"))
    return _lines(spark, sf_dir, 0).select(
        F.col("c_name").alias("vendor"), F.col("p_name").alias("product"), rating.alias("rating"),
        F.concat(F.floor("l_extendedprice").cast("int").cast("string"), F.lit(".5 cr")).alias("price_paid"),
        currency.alias("currency"))


def vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the number of their reviews."""
    counts = review(spark, sf_dir).groupBy("vendor").agg(F.count(F.lit(1)).alias("review_count"))
    t = lambda name: table(spark, sf_dir, name)
    people = (t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("about_text"),
                      F.col("r_name").alias("marketplace")))
    return people.join(counts, F.col("name") == F.col("vendor"), "left").select(
        "name", "about_text", F.coalesce("review_count", F.lit(0)).alias("review_count"), "marketplace")


def rates(spark: SparkSession) -> DataFrame:
    """Exchange rates per euro, a parameter of the conversion."""
    rows = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(r).alias("per_eur")) for c, r in RATES])
    return spark.range(1).select(F.inline(rows))


LISTING_SQL = """listing as (
  select p_name as name, p_type as category, p_type as broad_category,
         l_extendedprice / l_quantity as price_usd, c_name as vendor, r_name as marketplace,
         case when p_type in ('PROMO', 'STANDARD') then 'Digital'
              when p_type in ('SMALL', 'MEDIUM', 'LARGE') then 'Physical' else 'Other' end as main_business
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
       join part on l_partkey = p_partkey
  where l_linenumber % 2 = 1)"""

REVIEW_SQL = """review as (
  select c_name as vendor, p_name as product,
         case l_returnflag when 'A' then 'positive' when 'R' then 'negative' end as rating,
         cast(cast(floor(l_extendedprice) as int) as varchar) || '.5 cr' as price_paid,
         case n_regionkey when 0 then 'USD' when 1 then 'CAD ' when 2 then 'EUR' when 3 then 'GBP'
              else 'XMR' end as currency
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
       join part on l_partkey = p_partkey
  where l_linenumber % 2 = 0)"""

VENDOR_SQL = REVIEW_SQL + """, vendors as (
  select c_name as name, c_mktsegment as about_text, coalesce(n, 0) as review_count, r_name as marketplace
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
       left join (select vendor, count(*) as n from review group by 1) on vendor = c_name)"""
