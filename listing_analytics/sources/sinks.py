"""Sinks (A6-A8, A10, A11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_analytics.operators.clean import dedup_keep_first


def append_records(df: DataFrame, path: str, partition: str = "marketplace") -> None:
    """Append to the table of an entity, one partition per site."""
    df.write.mode("append").partitionBy(partition).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a result table."""
    df.write.mode("overwrite").parquet(path)


def latest(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last row per key; of rows with equal ``order`` the one whose contents have the largest hash."""
    return dedup_keep_first(df, keys, [F.col(order).desc(), F.xxhash64(*df.columns).desc()])


def stored_splits(fresh: DataFrame, path: str) -> DataFrame:
    """The stored rows of the splits that ``fresh`` touches; no other split is read."""
    touched = [r.split for r in fresh.select("split").distinct().collect()]
    stored = fresh.sparkSession.read.schema(fresh.schema).parquet(path)
    return stored.filter(F.col("split").isin(touched)).select(*fresh.columns)


def upsert_latest(df: DataFrame, keys: Sequence[str], order: str, path: str, buckets: int = 256) -> None:
    """Store rows by key; a later row of the same key replaces the stored one.

    The table is split by a hash of the key into ``buckets`` folders; choose their number by the size of the table. Only
    the splits that receive rows are read, by a partition filter on their numbers (``buckets`` numbers at most), and
    rewritten (dynamic partition overwrite). Until its commit a job writes beside the table: one that is lost before
    leaves what readers see as it was. The commit moves split after split; one lost in its middle leaves some splits old and
    some new, each whole, and running it again mends that.
    """
    spark = df.sparkSession
    split = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = df.withColumn("split", split)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        fresh = fresh.unionByName(stored_splits(fresh, path))
    # Rebalancing keeps a split together where it is small and cuts it where it is large.
    (latest(fresh, keys, order).hint("rebalance", "split").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("split").parquet(path))


def split_accept_reject(df: DataFrame, accept: Column, reason: str | Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the others with a reason (A10, A11). Null counts as not passed."""
    passed = F.coalesce(accept, F.lit(False))
    why = F.lit(reason) if isinstance(reason, str) else reason
    return df.filter(passed), df.filter(~passed).withColumn("reason", why)


def divert_challenges(scored: DataFrame, detected_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Content pages, and challenge pages with the time of detection for their own store."""
    when = F.current_timestamp() if detected_at is None else detected_at
    content, challenge = split_accept_reject(scored, ~F.col("is_challenge"), "challenge page")
    return content, challenge.withColumn("detected_at", when)
