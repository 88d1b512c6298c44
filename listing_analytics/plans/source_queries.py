"""Queries over sources and sinks (A) and incremental ingestion (I).

They write the given tables below the shared folder and read them back.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics import schemas
from listing_analytics.functions.urls import url_key
from listing_analytics.operators import challenge
from listing_analytics.plans import rendered, roles
from listing_analytics.plans.link_queries import _EDGES_SQL, page_edges
from listing_analytics.plans.page_queries import output_rows, output_rows_sql
from listing_analytics.plans.registry import query
from listing_analytics.plans.roles import LISTING_SQL, table
from listing_analytics.rules.site_n import site_n
from listing_analytics.session import scratch_path, store
from listing_analytics.sources import linkmap, pages, records, sinks
from listing_analytics.streaming import ingest

_L = f"with {LISTING_SQL}"


@query("A1_read_pages", "select page_id, url, md5(url) as url_hash, html from pages")
def a1(spark: SparkSession, sf: str) -> DataFrame:
    return pages.read_pages(spark, f"{sf}/pages.parquet")


_STORED_EDGES = f"with {_EDGES_SQL} select * from e"


@query("A2_read_linkmap", _STORED_EDGES)
def a2(spark, sf):
    path = scratch_path(spark, "linkmap")
    linkmap.write_linkmap(page_edges(spark, sf), path)
    return linkmap.read_linkmap(spark, path).select("src_hash", "src_url", "dst_hash", "dst_url")


@query("A3_read_records", f"""{_L} select name, category, cast(cast(floor(price_usd) as bigint) as varchar) as price,
  'say "hi", ' || vendor || chr(10) || marketplace as description, vendor from listing""")
def a3(spark, sf):
    path = scratch_path(spark, "records")
    description = F.concat(F.lit('say "hi", '), "vendor", F.lit("\n"), "marketplace")
    rows = roles.listing(spark, sf).select("name", "category", F.floor("price_usd").cast("bigint").cast("string").alias("price"),
                                           description.alias("description"), "vendor")
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    schema = schemas._strings("name", "category", "price", "description", "vendor")
    return records.read_records(spark, path, schema).drop("source_file", "row_ord")


@query("A4_read_labelled", "select text, case toxic when 1 then 'captcha' else 'non_captcha' end as label from documents join labels using (doc_id)")
def a4(spark, sf):
    path = scratch_path(spark, "corpus")
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    for name, toxic in (("captcha", 1), ("non_captcha", 0)):
        docs.filter(F.col("toxic") == toxic).select("text").write.parquet(os.path.join(path, name))
    return pages.read_labelled(spark, path, "parquet")


@query("A5_read_mapping", "select distinct p_type as key, lower(p_type) as value from part")
def a5(spark, sf):
    path = scratch_path(spark, "mapping")
    kinds = table(spark, sf, "part").select("p_type").distinct()
    kinds.select(F.to_json(F.create_map("p_type", F.lower("p_type"))).alias("value")).write.option(
        "maxRecordsPerFile", 1).text(path)
    return records.read_mapping(spark, path)


@query("A6_append_records", f"{_L} select name, vendor, price_usd, marketplace from listing")
def a6(spark, sf):
    path = scratch_path(spark, "products")
    rows = roles.listing(spark, sf).select("name", "vendor", "price_usd", "marketplace")
    for part in (rows.filter("price_usd < 1000"), rows.filter("price_usd >= 1000")):
        sinks.append_records(part, path)
    return spark.read.parquet(path)


@query("A7_overwrite", f"{_L} select main_business, count(*) as n from listing group by 1")
def a7(spark, sf):
    path = scratch_path(spark, "mart")
    rows = roles.listing(spark, sf)
    sinks.overwrite(rows.select("main_business"), path)
    sinks.overwrite(rows.groupBy("main_business").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)


@query("A8_upsert_latest", """select md5(url) as url_hash, case when url like 'https%' then 'second' else 'first' end as save, length(html) as size from pages""")
def a8(spark, sf):
    path = scratch_path(spark, "page-store")
    first = table(spark, sf, "pages").select(url_key(F.col("url")).alias("url_hash"), F.lit("first").alias("save"),
                                             F.length("html").cast("bigint").alias("size"), F.lit(1).alias("fetched_at"), "url")
    again = first.filter(F.col("url").startswith("https")).withColumns({"save": F.lit("second"), "fetched_at": F.lit(2)})
    for saved in (first, again):
        sinks.upsert_latest(saved.drop("url"), ["url_hash"], "fetched_at", path, buckets=16)
    return spark.read.parquet(path).select("url_hash", "save", "size")


@query("A9_write_linkmap", """select md5(url) as src_hash, url as original, len(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1))) as n_children from pages""")
def a9(spark, sf):
    path = scratch_path(spark, "linkmap")
    linkmap.write_linkmap(page_edges(spark, sf), path)
    parsed = spark.read.text(path).select(F.from_json("value", schemas.LINK_MAP).alias("m"))
    return parsed.select(F.explode("m").alias("src_hash", "page")).select(
        "src_hash", F.col("page.original").alias("original"),
        F.size("page.children").cast("bigint").alias("n_children"))


@query("A10_processed_and_rejects", f"""{_L} select name, vendor, price_usd,
  case when price_usd < 2000 then null else 'too dear' end as reason from listing""")
def a10(spark, sf):
    rows = store(roles.listing(spark, sf), "listing")
    accepted, rejected = sinks.split_accept_reject(rows, F.col("price_usd") < 2000, "too dear")
    columns = ["name", "vendor", "price_usd", "reason"]
    return accepted.withColumn("reason", F.lit(None).cast("string")).select(columns).unionByName(rejected.select(columns))


@query("A11_divert_challenges", """select doc_id, case when hit then 'challenge page' end as reason,
    case when hit then cast('2024-01-01 00:00:00' as timestamp) end as detected_at
  from (select doc_id, lower(text) like '%token%' as hit from documents)""")
def a11(spark, sf):
    scored = store(challenge.match_phrases(table(spark, sf, "documents"), "text", ["token"]).withColumnRenamed("hit", "is_challenge"), "scored")
    content, diverted = sinks.divert_challenges(scored, F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    diverted = store(diverted, "diverted").select("doc_id", "reason", "detected_at")
    return diverted.unionByName(content.select("doc_id"), allowMissingColumns=True)


def _arrivals(rows: DataFrame, path: str) -> str:
    """Three overlapping deliveries of pages: by protocol, then all again."""
    secure = F.col("url").startswith("https")
    for name, part in (("1", rows.filter(secure)), ("2", rows.filter(~secure)), ("3", rows)):
        part.write.option("compression", "zstd").parquet(os.path.join(path, f"delivery-{name}"))
    return path


@query("I1_ingest_pages", "select page_id, url, md5(url) as url_hash, length(html) as size from pages")
def i1(spark, sf):
    base = scratch_path(spark, "ingest")
    source = _arrivals(table(spark, sf, "pages"), os.path.join(base, "in"))
    for _ in range(2):  # the second start finds nothing new
        ingest.ingest_pages(spark, source, os.path.join(base, "out"), os.path.join(base, "state"),
                            files_per_batch=2).awaitTermination()
    return ingest.read_ingested(spark, os.path.join(base, "out"), "pages").select(
        "page_id", "url", "url_hash", F.length("html").cast("bigint").alias("size"))


# Equal pages have one URL, so each is delivered once per delivery and extracted once overall.
@query("I2_ingest_records", f"""{_L}, p as (select distinct vendor, marketplace, category, main_business,
    case when main_business = 'Other' then null else name end as name,
    case when main_business = 'Other' then null else cast(cast(floor(price_usd) as bigint) as varchar) end as amount from listing)
  {output_rows_sql('p')}""")
def i2(spark, sf):
    base = scratch_path(spark, "ingest")
    # Equal pages are found by the few columns that they show, and pages are only written where they are delivered: no page is
    # moved or stored for that. A page without all that it shows is null.
    rows, html, c = roles.listing(spark, sf), rendered.mixed_n(), F.col
    whole, found = html.isNotNull(), c("main_business") != "Other"
    shown = [F.when(found, c("name")).alias("name"), "vendor", F.when(whole, c("main_business")).alias("main_business"),
             F.when(whole & found, c("category")).alias("category"), F.when(whole & found, F.floor("price_usd")).alias("price_usd"),
             F.when(whole & (c("main_business") == "Physical"), c("marketplace")).alias("marketplace")]
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    html = F.when(c("main_business").isNotNull(), html)
    made = store(rows.select(*shown).repartition(slots, "vendor", "name", "price_usd").distinct().withColumn("page_id", F.xxhash64(html)), "pages")
    delivered = made.withColumn("html", html).select(
        "page_id", F.concat(F.when(c("page_id") > 0, "https").otherwise("http"), F.lit("://h.test/"), F.md5("html")).alias("url"), "html")
    source = _arrivals(delivered, os.path.join(base, "in"))
    out = os.path.join(base, "out")
    ingest.ingest_records(spark, source, site_n(), out, os.path.join(base, "state"), files_per_batch=8).awaitTermination()
    tables = {t: ingest.read_ingested(spark, out, t) for t in ("product", "vendor", "review", "processed", "rejects")}
    return output_rows(tables, made.select("page_id", "name", "vendor"))
