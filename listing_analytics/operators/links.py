"""Link graph and crawl bookkeeping as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_analytics.functions.urls import authority, resolve_links, url_key
from listing_analytics.operators.clean import dedup_keep_first
from listing_analytics.operators.order import ROW_IN_PART, part_starts, place, store_in_order
from listing_analytics.operators.visited import VisitedRuns
from listing_analytics.session import scratch_path, ship_package


def resolved_links(shredded: DataFrame, url: str = "url") -> DataFrame:
    """Absolute targets of all links of each page, in document order, as column ``links``.

    Narrow: one Python call per page, no row per link.
    """
    ship_package(shredded.sparkSession)
    anchors = F.filter("nodes", lambda n: n["tag"] == "a")
    hrefs = F.transform(anchors, lambda n: n["attrs"]["href"])
    return shredded.withColumn("links", resolve_links(F.col(url), hrefs))


def internal_links(linked: DataFrame, url: str = "url") -> DataFrame:
    """Keep the different targets on the page's own host and port (C2), without any shuffle."""
    host = authority(F.col(url))
    own = F.filter("links", lambda t: t.isNotNull() & (t != "") & (authority(t) == host))
    return linked.withColumn("links", F.array_distinct(own))


def link_records(linked: DataFrame, order: Sequence[str | Column], url: str = "url") -> DataFrame:
    """(src_hash, src_url, links): first record per page wins (C4)."""
    rows = linked.withColumn("src_hash", url_key(F.col(url)))
    names = [c for c in order if isinstance(c, str)]
    slim = rows.select("src_hash", F.col(url).alias("src_url"), "links",
                       *[F.col(c).alias(f"_{c}") for c in names])
    keys = [f"_{c}" if isinstance(c, str) else c for c in order]
    return dedup_keep_first(slim, ["src_hash"], keys).select("src_hash", "src_url", "links")


def edges(records: DataFrame) -> DataFrame:
    """One row per link; a page without links keeps one row with a null target."""
    return records.select("src_hash", "src_url", F.explode_outer("links").alias("dst_url")).select(
        "src_hash", "src_url", url_key(F.col("dst_url")).alias("dst_hash"), "dst_url")


def unvisited(df: DataFrame, visited: DataFrame, key: str = "url_hash") -> DataFrame:
    """Rows whose page was not fetched in any session."""
    return df.join(visited.select(key).distinct(), key, "left_anti")


def frontier(links: DataFrame, visited: DataFrame, queue: DataFrame, seen: str | None = None) -> DataFrame:
    """Discovered pages that are neither visited nor queued, with when they were first seen.

    The targets are combined per task before they are shuffled, so a page that a large part of all
    links point to costs one row per task.
    """
    first = F.min(seen) if seen else F.lit(0)
    found = (links.filter("dst_hash is not null").groupBy(F.col("dst_hash").alias("url_hash"))
             .agg(F.min("dst_url").alias("url"), first.alias("queue_ord")))
    return unvisited(unvisited(found, visited), queue).withColumn("queue_round", F.lit(0))


def requeue(waiting: DataFrame, failed: DataFrame) -> DataFrame:
    """Put failed fetches at the tail: they keep their order in a later round.

    The queue order is ``(queue_round, queue_ord)``, so no row number over the whole queue is needed.
    """
    return waiting.unionByName(failed.withColumn("queue_round", F.col("queue_round") + 1))


def requeue_challenged(waiting: DataFrame, challenged: DataFrame) -> DataFrame:
    """Put pages that answered with a challenge back at the tail, each once (C10 for the diverted pages of A11).

    ``challenged`` has the columns of the queue; a page that met a challenge in its second round is left out.
    """
    return requeue(waiting, challenged.filter(F.col("queue_round") == 0).select(*waiting.columns))


def hop_levels(links: DataFrame, seeds: DataFrame, max_hops: int | None = None, order: str | None = None,
               seed_order: str | None = None, visited: DataFrame | None = None) -> DataFrame:
    """Breadth-first search from the seeds (C7): (url_hash, level, position) of every page it reaches.

    ``links`` has (src_hash, dst_hash) and, named by ``order``, the place of a link on its page; ``seeds`` has url_hash and
    maybe ``seed_order``. Pages queue up first seen, first served: ``position`` (0, 1, 2, ...) follows the position of the
    first page that links there, then the place of the link, then the key. Pages in ``visited`` (url_hash) are neither
    listed nor followed. Null ends are ignored. The search goes on until no new page turns up; with ``max_hops`` it raises
    when pages further away are left.

    Links are hashed by source once and visited pages lie in levelled runs, so a hop shuffles only its frontier and
    its candidates, which are combined per task first. Positions are prefix sums of counts per partition.
    """
    spark = links.sparkSession
    level_path = scratch_path(spark, "levels")
    level, start, starts = 0, 0, []
    with VisitedRuns(spark) as runs:
        # A link that a page repeats counts where it comes first.
        dealt = links.filter("src_hash is not null and dst_hash is not null").select(
            "src_hash", "dst_hash", (F.col(order) if order else F.lit(0)).alias("ord")).repartition(runs.buckets, "src_hash")
        name, _ = runs.hashed(dealt.groupBy("src_hash", "dst_hash").agg(F.min("ord").alias("ord")), "src_hash", name="edges")
        if visited is not None:
            runs.add(visited.filter("url_hash is not null").select("url_hash").distinct())
        fresh = seeds.filter("url_hash is not null").groupBy("url_hash").agg(
            F.lit(0).cast("long").alias("parent"), F.min(seed_order or F.lit(0)).alias("ord"))
        while True:
            found = runs.add(runs.missing(fresh, "parent"), dealt=True)
            path, counts = store_in_order(found.select("url_hash", "parent", "ord"), "parent", "ord", "url_hash",
                                          path=f"{level_path}/level={level}")
            runs.release()
            if not counts:
                break
            if max_hops is not None and level > max_hops:
                raise ValueError(f"pages more than {max_hops} hops away are left")
            begins = part_starts(counts, start)
            starts += [(level, part, before) for part, before in begins]
            frontier_pages = spark.read.schema(f"url_hash {_kind(links)}, row_id long").parquet(path).select(
                F.col("url_hash").alias("src_hash"), place(begins).alias("position"))
            step = spark.table(name).join(frontier_pages, "src_hash")
            # A page links to another once, so the least position also has the link's place.
            fresh = step.groupBy(F.col("dst_hash").alias("url_hash")).agg(
                F.min("position").alias("parent"), F.min_by("ord", "position").alias("ord"))
            level, start = level + 1, start + sum(n for _, n in counts)
    # One row per partition of a level that has pages.
    offsets = spark.createDataFrame(starts, "level int, part long, before long")
    pages = spark.read.schema(f"url_hash {_kind(links)}, row_id long, level int").parquet(level_path)
    return (pages.withColumn("part", F.shiftright("row_id", 33)).join(F.broadcast(offsets), ["level", "part"])
            .select("url_hash", "level", (F.col("before") + F.col("row_id").bitwiseAND(F.lit(ROW_IN_PART))).alias("position")))


def _kind(links: DataFrame) -> str:
    return links.schema["src_hash"].dataType.simpleString()


def budget(levels: DataFrame, n: int) -> DataFrame:
    """Pages of one session: the first ``n`` of the queue, which is the feature (C8). Narrow: positions have no gaps."""
    return levels.filter(F.col("position") < n)


def extension(content_type: Column) -> Column:
    """File extension of a supported content type, else null."""
    return (F.when(content_type.contains("text/html"), ".html")
            .when(content_type.contains("image/jpeg") | content_type.contains("image/jpg"), ".jpeg")
            .when(content_type.contains("image/png"), ".png"))


def by_content_type(df: DataFrame, content_type: str = "content_type") -> DataFrame:
    """Supported resources with extension; only HTML is searched for links."""
    return df.withColumn("extension", extension(F.col(content_type))).filter("extension is not null").withColumn(
        "has_links", F.col("extension") == ".html")
