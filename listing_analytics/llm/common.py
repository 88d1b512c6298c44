"""What the operators share: reading tables, written intermediate tables, and text as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.session import discard, scratch_path, ship_package  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ship_package(spark)


_MADE: list[str] = []


def store(df: DataFrame, name: str, *partition_by: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared folder and read it back: a cut in the lineage that outlives any executor."""
    path = scratch_path(df.sparkSession, name)
    _MADE.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def made_so_far() -> int:
    return len(_MADE)


def sweep(spark: SparkSession, since: int, *keep: str) -> None:
    """Delete the intermediate tables made since ``since`` but those in ``keep``. What reads them must have been stored."""
    discard(spark, *[path for path in _MADE[since:] if path not in keep])
    _MADE[since:] = [path for path in _MADE[since:] if path in keep]


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Id and whole text under fixed names; a null text is an empty one.

    Other columns stay behind, so their names cannot clash; those named in ``carry`` come along inside ``carried``.
    """
    more = [] if carry is None else [F.struct(*[F.col(c) for c in carry]).alias("carried")]
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, one value at a time and without a copy of the whole column."""
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    data, offsets = memoryview(column.buffers()[2] or b""), memoryview(column.buffers()[1]).cast("q")
    at = column.offset
    for i in range(at, at + len(column)):
        yield bytes(data[offsets[i]:offsets[i + 1]])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
