"""Documents to training sequences: stages that each take the whole output of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.llm import line_dedup, packing, quality_qda, simhash_bk
from listing_analytics.llm.common import made_so_far, store, sweep, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go, rows and columns stay as they are.

    Null and empty texts are scored like any other; repeated rows get equal scores and stay or go together. Null ids have
    no label. Where ``labels`` has no rows of both classes, nothing can be told apart and all documents stay. An empty table
    gives an empty one.
    """
    return quality_qda.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all documents but the first; no document goes.

    A null text becomes an empty one. Rows of equal id are one document: lines that only it has stay in each of its rows.
    Rows without an id keep their lines. ``n_chars`` is counted anew. An empty table gives an empty one.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    kept = line_dedup.dedup_lines(docs, carry=others)
    now = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*[now[c].alias(c) if c in now else F.col(f"carried.{c}") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Texts without words (null and empty ones, too) are one group. Of repeated rows one stays, rows without an id only where
    their group has no other. An empty table gives an empty one.
    """
    return simhash_bk.keep_one(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of training sequences with their token ids.

    A null or empty text is its end token alone; repeated rows and null ids are documents like others. An empty table gives
    no pieces.
    """
    return packing.pack(docs, with_ids=True)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("sequences", sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. When a stage is stored, what it read and made on its way is deleted."""
    docs, since = table(spark, sf_dir, "documents"), made_so_far()
    for name, stage in STAGES:
        docs, path = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
        sweep(spark, since, path)
    return docs
