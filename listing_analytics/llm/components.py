"""Connected components by alternating stars: a logarithmic number of rounds, each a few shuffles of the edges.

No neighbourhood is ever gathered: a round needs the smallest neighbour of each node, an aggregate that combines before
its shuffle, and joins it back to the edges. Each round is written to the shared folder and the one before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_analytics.llm.common import discard, store


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with m, the least of a and all its b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").withColumn("m", F.least("a", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are tied to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the least of them. Needs a > b."""
    tied = _with_least(edges)
    return tied.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                       .alias("e")).select("e.a", "e.b").filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that it is connected with.

    Self-loops, repeated edges and edges with a null end are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    current, path = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(current)
    while before[0]:
        stars, stars_path = store(_small_star(_large_star(current)), "edges")
        discard(spark, path)
        current, path, now = stars, stars_path, mark(stars)
        if now == before:
            break
        before = now
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
