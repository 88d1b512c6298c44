"""Queries over the link graph (C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.functions.urls import url_key
from listing_analytics.operators import challenge
from listing_analytics.operators import links as lk
from listing_analytics.operators.shred import shred
from listing_analytics.plans import roles
from listing_analytics.plans.registry import query
from listing_analytics.plans.roles import LISTING_SQL, table
from listing_analytics.session import store
from listing_analytics.sources import sinks

# Every link of the test pages starts at the root of its own host.
_LINKS_SQL = """l as (select page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages),
  t as (select page_id, url, trim(regexp_extract(url, '^[a-z]+://[^/?#]*') || replace(href, '&amp;', '&'), '/') as target from l)"""
_EDGES_SQL = f"""{_LINKS_SQL}, e as (select distinct md5(url) as src_hash, url as src_url, md5(target) as dst_hash,
  target as dst_url from t)"""

# The graph of vendors and the products they list, in both directions; a page's links are in the order of the listings'
# lines. Nothing is 12 hops away; the bound only ends the recursion, which would go round in circles. A page is queued by
# the place of the first page that links to it, then by the place of that link.
_LINE_SQL = "cast(l_orderkey * 8 + l_linenumber as bigint) as line"
_GRAPH_SQL = f"""{LISTING_SQL.replace("as main_business", f"as main_business, {_LINE_SQL}")},
  g as (select md5('v:' || vendor) as src, md5('p:' || name) as dst, min(line) as ord from listing group by 1, 2
    union all select md5('p:' || name), md5('v:' || vendor), min(line) from listing group by 1, 2),
  w as (select src, level from (select md5('v:' || min(vendor)) as src, 0 as level from listing) s
    union select g.dst, level + 1 from w join g on g.src = w.src where level < 12),
  h as (select src as url_hash, min(level) as level from w group by 1),
  b as (select level, sum(count(*)) over (order by level) as before from h group by 1),
  q as (select url_hash, level, 0::bigint as position from h where level = 0
    union all select dst, level + 1, cast(before + row_number() over (order by parent, ord, dst) - 1 as bigint)
    from (select g.dst, q.level, any_value(b.before) as before, min(q.position) as parent, arg_min(g.ord, q.position) as ord
          from q join g on g.src = q.url_hash join h on h.url_hash = g.dst and h.level = q.level + 1 join b on b.level = q.level
          group by 1, 2))"""


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    return lk.resolved_links(shred(table(spark, sf, "pages")))


def page_edges(spark: SparkSession, sf: str) -> DataFrame:
    return lk.edges(lk.link_records(lk.internal_links(_linked(spark, sf)), ["page_id"]))


@query("C1_resolve_links", f"with {_LINKS_SQL} select page_id, target from t")
def c1(spark, sf):
    return _linked(spark, sf).select("page_id", F.explode("links").alias("target"))


@query("C2_internal_links", f"with {_LINKS_SQL} select distinct page_id, target from t")
def c2(spark, sf):
    return lk.internal_links(_linked(spark, sf)).select("page_id", F.explode("links").alias("target"))


@query("C3_url_key", "select page_id, md5(url) as url_hash from pages")
def c3(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_key(F.col("url")).alias("url_hash"))


@query("C4_edges", f"with {_EDGES_SQL} select * from e")
def c4(spark, sf):
    return page_edges(spark, sf)


def _vendor_graph(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles.listing(spark, sf, F.expr(_LINE_SQL)).select(
        F.concat(F.lit("v:"), "vendor").alias("v"), F.concat(F.lit("p:"), "name").alias("p"), "price_usd", "line")
    both = rows.select("line", F.inline(F.array(
        F.struct(F.col("v").alias("src"), F.col("p").alias("dst"), F.col("price_usd").alias("seen")),
        F.struct(F.col("p").alias("src"), F.col("v").alias("dst"), F.col("price_usd").alias("seen")))))
    return both.select(url_key(F.col("src")).alias("src_hash"), F.col("src").alias("src_url"),
                       url_key(F.col("dst")).alias("dst_hash"), F.col("dst").alias("dst_url"), "seen", "line")


@query("C5_unvisited", f"""with {LISTING_SQL} select distinct md5('v:' || vendor) as url_hash from listing
  where vendor not in (select vendor from listing where main_business = 'Digital')""")
def c5(spark, sf):
    rows = roles.listing(spark, sf).withColumn("url_hash", url_key(F.concat(F.lit("v:"), "vendor")))
    return lk.unvisited(rows.select("url_hash").distinct(), rows.filter("main_business = 'Digital'"))


@query("C6_frontier", f"""with {LISTING_SQL}, found as (select md5('p:' || name) as url_hash, 'p:' || name as url, min(price_usd) as queue_ord
    from listing group by 1, 2 union all select md5('v:' || vendor), 'v:' || vendor, min(price_usd) from listing group by 1, 2)
  select *, 0 as queue_round from found where url_hash not in (select md5('v:' || vendor) from listing where category = 'SMALL')
    and url_hash not in (select md5('p:' || name) from listing where category = 'LARGE' and price_usd > 2000)""")
def c6(spark, sf):
    rows = roles.listing(spark, sf)
    visited = rows.filter("category = 'SMALL'").select(url_key(F.concat(F.lit("v:"), "vendor")).alias("url_hash"))
    queued = rows.filter("category = 'LARGE' and price_usd > 2000").select(
        url_key(F.concat(F.lit("p:"), "name")).alias("url_hash"))
    return lk.frontier(_vendor_graph(spark, sf), visited, queued, "seen")


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    seed = roles.listing(spark, sf).agg(url_key(F.concat(F.lit("v:"), F.min("vendor"))).alias("url_hash"))
    return lk.hop_levels(_vendor_graph(spark, sf).select("src_hash", "dst_hash", "line"), seed, order="line")


@query("C7_hop_levels", f"with recursive {_GRAPH_SQL} select * from q")
def c7(spark, sf):
    return _levels(spark, sf)


@query("C8_budget", f"with recursive {_GRAPH_SQL} select * from q where position < 200")
def c8(spark, sf):
    return lk.budget(_levels(spark, sf), 200)


@query("C9_content_type", """
  select event_id, case event_type when 'view' then '.html' when 'click' then '.jpeg' when 'purchase' then '.png' end as extension,
         event_type = 'view' as has_links from events where event_type in ('view', 'click', 'purchase')""")
def c9(spark, sf):
    kind = F.col("event_type")
    typed = table(spark, sf, "events").select("event_id", F.when(kind == "view", "text/html; charset=utf-8").when(
        kind == "click", "image/jpg").when(kind == "purchase", "image/png").otherwise("text/css").alias("content_type"))
    return lk.by_content_type(typed).drop("content_type")


@query("C10_requeue", """
  select o_orderkey as queue_ord, cast(case o_orderstatus when 'F' then 1 else 0 end as int) as queue_round from orders""")
def c10(spark, sf):
    queue = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("queue_ord"), F.lit(0).alias("queue_round"), "o_orderstatus")
    waiting = queue.filter("o_orderstatus <> 'F'").drop("o_orderstatus")
    failed = queue.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    return lk.requeue(waiting, failed)


@query("C10_requeue_challenged", """
  select page_id as queue_ord, url, cast(case when page_id % 3 = 0 or hit then 1 else 0 end as int) as queue_round
  from (select *, lower(html) like '%www.%' as hit from pages) where not (page_id % 3 = 0 and hit)""")
def c10_challenged(spark, sf):
    """Pages that hold a phrase are diverted; every third one is in its second round already."""
    flagged = challenge.match_phrases(table(spark, sf, "pages"), "html", ["www."]).withColumnRenamed("hit", "is_challenge")
    queue = flagged.select(F.col("page_id").alias("queue_ord"), "url", F.when(F.col("page_id") % 3 == 0, 1).otherwise(0).alias("queue_round"),
                           "is_challenge")
    content, diverted = sinks.divert_challenges(store(queue, "queue"))
    return lk.requeue_challenged(content.drop("is_challenge"), diverted)
