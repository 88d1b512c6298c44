"""Incremental ingestion of pages and records.

Both jobs keep which pages were seen in the state of the stream, which lives in the checkpoint and
grows with the number of pages only; a batch costs what the batch holds. Each batch is written to
its own ``batch_id`` folder, so a batch that is replayed after a failure replaces itself.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from listing_analytics import schemas
from listing_analytics.functions.urls import url_key
from listing_analytics.operators.extract import extract_pages, split_records
from listing_analytics.rules.model import Site

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _arrivals(spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    # The set of seen pages may outgrow the heap; RocksDB keeps it on disk with checkpoints.
    if "HDFSBackedStateStoreProvider" in spark.conf.get(_PROVIDER):
        spark.conf.set(_PROVIDER, ROCKSDB)
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "true").parquet(source))


def _batch_path(sink: str, table: str, batch_id: int) -> str:
    return os.path.join(sink, table, f"batch_id={batch_id}")


def _free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffled pages of batches that are done: it does so when the driver's heap is collected, which
    otherwise may not happen before the stream ends."""
    spark._jvm.System.gc()


def ingest_pages(spark: SparkSession, source: str, sink: str, checkpoint: str,
                 visited: DataFrame | None = None, schema: T.StructType = schemas.PAGE,
                 files_per_batch: int = 1000) -> StreamingQuery:
    """Store each page that arrives below ``source`` once, also across restarts.

    ``visited`` holds the ``url_hash`` of pages from before the stream. The result is below
    ``sink/pages``, one folder per batch.
    """
    fresh = _arrivals(spark, source, schema, files_per_batch).withColumn("url_hash", url_key(F.col("url")))
    if visited is not None:
        fresh = fresh.join(visited.select("url_hash"), "url_hash", "left_anti")
    fresh = fresh.dropDuplicates(["url_hash"])

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(_batch_path(sink, "pages", batch_id))
        _free_shuffles(batch.sparkSession)

    return (fresh.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_records(spark: SparkSession, source: str, site: Site, sink: str, checkpoint: str,
                   schema: T.StructType = schemas.PAGE, key: str = "page_id", identity: str = "url",
                   files_per_batch: int = 1000) -> StreamingQuery:
    """Extract the records of arriving pages, each page once, with done and error logs.

    Pages are shredded once per batch into ``sink/extracted``; the five tables are derived from it. A page is known by
    the 128-bit key of its ``identity`` column (a URL or path); pages without one are known by ``key``.
    """
    fresh = _arrivals(spark, source, schema, files_per_batch)
    known_by = F.coalesce(url_key(F.col(identity)), F.col(key).cast("string")) if identity in schema.fieldNames() else F.col(key).cast("string")
    fresh = fresh.withColumn("_known_by", known_by).dropDuplicates(["_known_by"]).drop("_known_by")

    def store(batch: DataFrame, batch_id: int) -> None:
        staged = _batch_path(sink, "extracted", batch_id)
        extract_pages(batch, site).write.mode("overwrite").option("compression", "zstd").parquet(staged)
        tables = split_records(batch.sparkSession.read.parquet(staged), [key])
        for name, table in tables.items():
            table.write.mode("overwrite").option("compression", "zstd").parquet(_batch_path(sink, name, batch_id))
        _free_shuffles(batch.sparkSession)

    return (fresh.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_ingested(spark: SparkSession, sink: str, table: str) -> DataFrame:
    """All batches of one output table."""
    return spark.read.parquet(os.path.join(sink, table)).drop("batch_id")
