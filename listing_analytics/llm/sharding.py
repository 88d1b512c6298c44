"""Sharding: a Feistel permutation over global row numbers, in DataFrame expressions only.

Rows get numbers 0..N-1 in an order that only their content decides. The permutation of those numbers deals them out:
place p goes to shard ``p mod shards`` as slot ``p div shards``, so shard sizes differ by one at most, slots have no
gaps, and shard and slot of a row number can be computed (and inverted) without looking at any other row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listing_analytics.llm.common import store, table
from listing_analytics.llm.registry import query

SHARDS = 24
SEED = 20240607
ROUNDS = 6
BUCKETS = 8192  # of the row numbering; part of the order, hence no matter of the cluster


def _div(x: Column, y: int) -> Column:
    return F.call_function("div", x, F.lit(y).cast("long"))


def _mod(x: Column, y: int) -> Column:
    return F.pmod(x, F.lit(y).cast("long"))


def sides(n: int) -> tuple[int, int]:
    """Sides of a near-square grid of at least ``n`` cells; the cells too many are fewer than a side is long."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def feistel(x: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """One pass over the grid: of the halves (l, r) of x each in turn is shifted by a hash of the other.

    Every round is a bijection whatever the sides are.
    """
    a, b = sides(n)
    keys = range(ROUNDS)[::-1] if inverse else range(ROUNDS)

    def turn(half: Column, k: Column) -> Column:
        left, right = half["l"], half["r"]
        by_right = _mod(F.xxhash64(F.lit(seed), k, right), a)
        by_left = _mod(F.xxhash64(F.lit(seed), k, left), b)
        even = k % 2 == 0
        return F.struct(
            F.when(even, _mod(left - by_right if inverse else left + by_right, a)).otherwise(left).alias("l"),
            F.when(even, right).otherwise(_mod(right - by_left if inverse else right + by_left, b)).alias("r"))

    start = F.struct(_div(x, b).alias("l"), _mod(x, b).alias("r"))
    return F.aggregate(F.array(*[F.lit(k) for k in keys]), start, turn, lambda half: half["l"] * F.lit(b).cast("long") + half["r"])


def passes(spark: SparkSession, n: int, seed: int) -> int:
    """The most passes that any row number needs until it is below ``n``.

    Walks leave the row numbers at cells too many that no such cell maps to; from there each is followed back. Cells too
    many that only lead to each other are on nobody's way.
    """
    a, b = sides(n)
    surplus, needed = spark.range(n, a * b), 1
    step = lambda df: df.select(feistel(F.col("id"), n, seed).alias("id")).filter(F.col("id") >= n)
    on_the_way = surplus.join(step(surplus), "id", "left_anti")
    while on_the_way.count():
        on_the_way = step(on_the_way)
        needed += 1
    return needed


def permute(x: Column, n: int, seed: int, walks: int, inverse: bool = False) -> Column:
    """The place of row number ``x`` among ``n`` (or the row number at a place): passes until the value is below n."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(walks)), x.cast("long"), lambda at, k: F.when(
        (k == 1) | (at >= F.lit(n).cast("long")), feistel(at, n, seed, inverse)).otherwise(at))


def numbered(df: DataFrame, key: Column, order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``row_number`` 0..N-1, gapless: by hash bucket of ``key``, then by ``order`` inside the bucket.

    Only counts of the buckets, ``buckets`` rows at most, meet in one place.
    """
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (rows.withColumn("_inside", inside).join(F.broadcast(offsets), "_bucket")
            .withColumn("row_number", F.col("_offset") + F.col("_inside") - 1).drop("_bucket", "_inside", "_offset"))


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its shard and slot.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, text_hash, row_number, shard, slot. A null text
    counts as empty, a null id is kept. Rows that are equal in id and text are interchangeable: each gets a place of its
    own, and the set of places is the same in every run. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows, _ = store(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash")), "shard-rows")
    n = rows.count()
    ordered = numbered(rows, F.struct("doc_id", "text_hash"), ["doc_id", "text_hash", "size", "text_crc32"])
    place = permute(F.col("row_number"), n, seed, passes(docs.sparkSession, n, seed))
    return (ordered.withColumn("_place", place)
            .withColumn("shard", _mod(F.col("_place"), shards).cast("int"))
            .withColumn("slot", _div(F.col("_place"), shards)).drop("_place"))


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards, row counts at most one apart."""
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
