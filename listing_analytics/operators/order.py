"""Places in a global order without a window over everything."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_analytics.session import scratch_path

ROW_IN_PART = (1 << 33) - 1  # Spark's row ids: partition number above 33 bits of row number


def longs(values: list[int]) -> Column:
    """A constant array of longs, kept short in the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def store_in_order(df: DataFrame, *order: str | Column, path: str | None = None) -> tuple[str, list[tuple[int, int]]]:
    """Write ``df`` sorted across the cluster, with a column ``row_id``; returns the path and (partition, rows) ascending.

    Rows are range-partitioned and sorted within the partitions; the only thing that meets on the driver is a count per
    partition.
    """
    path = path or scratch_path(df.sparkSession, "ordered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row_id", F.monotonically_increasing_id()).write.parquet(path)
    found = df.sparkSession.read.schema("row_id long").parquet(path)
    counts = found.groupBy(F.shiftright("row_id", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    return path, sorted((r["part"], r["n"]) for r in counts)


def part_starts(counts: list[tuple[int, int]], start: int = 0) -> list[tuple[int, int]]:
    """(partition, place of its first row), by a prefix sum of the counts."""
    return [(part, before) for (part, _), before in zip(counts, accumulate((n for _, n in counts), initial=start))]


def place(starts: list[tuple[int, int]], row_id: str = "row_id") -> Column:
    """The gapless place of a row that :func:`store_in_order` wrote."""
    dense = [0] * (max((part for part, _ in starts), default=-1) + 1)
    for part, before in starts:
        dense[part] = before
    return F.get(longs(dense), F.shiftright(row_id, 33).cast("int")) + F.col(row_id).bitwiseAND(F.lit(ROW_IN_PART))


def in_order(df: DataFrame, *order: str | Column, name: str = "position", start: int = 0) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in the given order, stored."""
    path, counts = store_in_order(df, *order)
    spark = df.sparkSession
    rows = spark.read.schema(df.schema.add("row_id", "long")).parquet(path)
    return rows.withColumn(name, place(part_starts(counts, start))).drop("row_id")
