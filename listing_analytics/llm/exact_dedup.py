"""Exact dedup, in DataFrame expressions only.

Texts are grouped by a 128-bit content hash and the bytes inside the groups are compared: a hash that two different
texts share is split into one group for each of them. Of every group one row stays, the one with the least or the
greatest id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listing_analytics.llm.common import discard, store, table
from listing_analytics.llm.registry import query

HOT_GROUPS = 4096  # groups with at least this share of all rows are broadcast, so never more than this many
SALTS = 16

_LEAST, _GREATEST = -(1 << 63), (1 << 63) - 1


def content_hash(text: Column) -> Column:
    """128 bits of the content."""
    return F.md5(text.cast("binary"))


def shared_hashes(texts: DataFrame) -> DataFrame:
    """Hashes of ``texts`` (hash, text) that stand for more than one text.

    Copies are combined by their bytes in every task before they are shuffled, so a group of any size sends one text
    per task.
    """
    different = texts.groupBy("hash", "text").agg(F.lit(1).alias("one"))
    return different.groupBy("hash").agg(F.count("one").alias("n")).filter("n > 1").select("hash")


def _split_by_bytes(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` (doc_id, hash, text) of the shared hashes, with the number of their text among those of the hash.

    The row side may hold one text many times: both sides are salted.
    """
    hit = rows.join(shared, "hash")
    texts = hit.groupBy("hash", "text").agg(F.lit(1).alias("one"))
    variants = (texts.select("hash", "text", F.row_number().over(Window.partitionBy("hash").orderBy("text")).alias("variant"))
                .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    return hit.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(
        variants, ["hash", "text", "salt"]).drop("salt")


def exact_groups(docs: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] = lambda text: text,
                 hashed: Callable[[Column], Column] = content_hash, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the group of equal texts it belongs to.

    Returns doc_id, keep_id (id of the row that stays), group_size, kept, text_sha256 (of the normalised text).
    ``keep`` is ``smallest`` or ``largest``, by id.

    A null text counts as empty. Rows with a null id take part; they stay only where their group has no other id, and
    keep_id is null then. Of rows with equal id and text one stays. Other columns are not read, so their names cannot
    clash. An empty table gives an empty result.

    Texts are shuffled once, to compare their bytes; everything else moves slim rows. Groups so large that they hold one
    of HOT_GROUPS parts of all rows, which are HOT_GROUPS at most, meet their rows by a broadcast of a row per group.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("hash", hashed(F.col("text")))
    slim = ["doc_id", "hash", F.sha2("text", 256).alias("text_sha256")]
    rows, _ = store(whole.select(*slim, F.lit(0).alias("variant"), F.monotonically_increasing_id().alias("row")), "exact-rows")
    shared, shared_path = store(shared_hashes(whole.select("hash", "text")), "exact-shared")
    if shared.isEmpty():
        discard(docs.sparkSession, shared_path)
    else:
        # Row numbers of the two parts may meet, but not inside a group.
        split = _split_by_bytes(whole, shared).select(*slim, "variant", F.monotonically_increasing_id().alias("row"))
        rows, _ = store(rows.join(shared, "hash", "left_anti").unionByName(split), "exact-rows")

    key = ["hash", "variant"]
    if keep == "smallest":
        best, row = F.min("doc_id"), F.min_by("row", F.coalesce("doc_id", F.lit(_GREATEST)))
    else:
        best, row = F.max("doc_id"), F.max_by("row", F.coalesce("doc_id", F.lit(_LEAST)))
    groups = rows.groupBy(*key).agg(best.alias("keep_id"), row.alias("keep_row"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.filter("group_size > 1")
    hot = F.col("group_size") * HOT_GROUPS >= rows.count()
    found = ["keep_id", "keep_row", "group_size"]
    dealt = rows.join(F.broadcast(groups.filter(hot)), key, "left")
    many = dealt.filter(F.col("group_size").isNotNull())
    few = dealt.filter(F.col("group_size").isNull()).drop(*found).join(groups.filter(~hot), key, "left")
    alone = F.col("group_size").isNull()
    return many.unionByName(few).select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256")


_SQL = """
  with t as (select doc_id, coalesce(text, '') as text from documents)
  select doc_id, max(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size,
         row_number() over (partition by text order by doc_id desc nulls last) = 1 as kept, sha256(text) as text_sha256
  from t"""


@query("op13_exact_dedup", _SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by equal texts; the largest id of each group stays."""
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")
