"""SpotSigs fingerprints, in DataFrame expressions only.

A spot is a common word (an anchor); its signature is the anchor and the chain of the content words that follow it,
common words in between left out. A text's fingerprint is the set of its signatures. Sets are compared by Jaccard
likeness, and only where their sizes allow the wanted likeness: they are partitioned by size so that a set meets only the
sets of its own and the next partition, under the rarest of its signatures.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listing_analytics.llm.common import let, partitions, store, table
from listing_analytics.llm.registry import query

CHAIN = 3
THRESHOLD = 0.8
BUCKETS_PER_PARTITION = 4  # ranges of ids for each shuffle partition

# Common words of the languages in the corpus; they are the anchors, and chains leave them out.
ANCHORS = """
a an and are as at be by for from he in is it not of on or that the this to was were which with you
au aux avec dans de des du en est et il la le les ne par pas pour que qui sur un une
auf das dem den der die ein eine ist mit nicht sich und von zu
al como con del el es las los más no para por se su una y
""".split()


def signatures(text: Column, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> Column:
    """Sorted distinct 64-bit signatures of a text. Without any spot it is one hash of all words, so never empty.

    Words are runs of letters and digits. A run of anchors counts as its last one, which is glued to the word after it.
    """
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    anchor = "(?:" + "|".join(sorted(set(anchors))) + ")"
    # The last anchor of a run is glued first; whatever anchors are left in front of a glued one go, one match each, so
    # that runs of any length need no stack. Those behind the last glued one end the text and stay.
    marked = F.regexp_replace(words, rf"(?<= )({anchor}) (?=[^ ])(?!{anchor} )", "$1:")
    glued = let(marked, lambda m: let(F.substring_index(m, ":", -1), lambda tail: F.concat(
        F.regexp_replace(F.substring(m, F.lit(1), F.length(m) - F.length(tail)), rf"(?<= ){anchor} ", ""), tail)))
    spots = F.regexp_extract_all(glued, F.lit(rf"(?<= )(?=([^ :]+:[^ ]+(?: [^ ]+){{0,{chain - 1}}} ))"), F.lit(1))
    found = let(spots, lambda some: F.when(F.size(some) > 0, some).otherwise(F.array(words)))
    return F.sort_array(F.array_distinct(F.transform(found, lambda spot: F.xxhash64(F.regexp_replace(spot, " [^ :]+:", " ")))))


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; 0 without a comparison where their sizes rule ``at_least`` out."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = common / (small + large - common)
    return F.when(small < at_least * large, F.lit(0.0)).otherwise(exact)


def size_partition(size: Column, threshold: float = THRESHOLD) -> Column:
    """Number of the size range; sets further apart than one range cannot reach the threshold."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9)).cast("int")


def near_pairs(sets: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Pairs of different signature sets with a likeness of ``threshold`` or more, and which document has which set.

    ``sets`` has doc_id and signatures. Equal sets form a class named by its fingerprint; pairs are between classes
    (a < b, likeness), so copies are not expanded. A set is filed in its size partition under as many of its rarest
    signatures as any partner must share one of, and looks there in its own partition and the one above.
    """
    keyed, _ = store(sets.select("doc_id", fingerprint(F.col("signatures")).alias("class"), "signatures"), "signature-sets")
    classes = keyed.groupBy("class").agg(F.first("signatures").alias("signatures"))
    spots = classes.select("class", F.size("signatures").alias("n"), F.explode("signatures").alias("spot"))
    counts = spots.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("class").orderBy("df", "spot")
    prefix = (spots.join(counts, "spot").withColumn("rank", F.row_number().over(order))
              .filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
              .select("class", "n", "spot", size_partition(F.col("n"), threshold).alias("part")))
    filed = prefix.select("spot", "part", F.col("class").alias("a"), F.col("n").alias("na"))
    asked = prefix.select("spot", F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"),
                          F.col("class").alias("b"), F.col("n").alias("nb"))
    found = (filed.join(asked, ["spot", "part"])
             .filter((F.col("a") != F.col("b")) & (F.col("na") <= F.col("nb")) & (F.col("na") >= threshold * F.col("nb") - 1e-9))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    pairs = (found.join(classes.select(F.col("class").alias("a"), F.col("signatures").alias("sa")), "a")
             .join(classes.select(F.col("class").alias("b"), F.col("signatures").alias("sb")), "b")
             .select("a", "b", likeness(F.col("sa"), F.col("sb"), threshold).alias("likeness"))
             .filter(F.col("likeness") >= threshold))
    return pairs, keyed.select("doc_id", "class")


def fingerprint(signature_set: Column) -> Column:
    """One name for a signature set: the SHA-256 of its sorted members."""
    return F.sha2(F.concat_ws(",", signature_set.cast("array<string>")), 256)


def _starts(keys: DataFrame) -> list[tuple[int, int]]:
    """First key (a, b) of each of the ranges that ``keys`` falls into, ascending; some for each shuffle partition."""
    found = (keys.repartitionByRange(BUCKETS_PER_PARTITION * partitions(keys.sparkSession), "a", "b")
             .groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("a", "b")).alias("low")).collect())
    return sorted((r["low"]["a"], r["low"]["b"]) for r in found)


def _position(a: Column, b: Column, starts: tuple[Column, Column], n: int) -> Column:
    """Zero-based number of the last of ``n`` ascending starts that the key reaches, by bisection."""
    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["l"] + at["h"] + 1) / 2).cast("int")
        x, y = (F.get(s, middle) for s in starts)
        reached = (x < a) | ((x == a) & (y <= b))
        return F.struct(F.when(reached, middle).otherwise(at["l"]).alias("l"),
                        F.when(reached, at["h"]).otherwise(middle - 1).alias("h"))

    steps = F.sequence(F.lit(1), F.lit(max(1, n.bit_length())))
    return F.aggregate(steps, F.struct(F.lit(0).alias("l"), F.lit(n - 1).alias("h")), halve, lambda at: at["l"])


def fingerprints_and_edits(docs: DataFrame, anchors: list[str] = ANCHORS, chain: int = CHAIN,
                           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Signature sets of every text and of its edited text, whose last half is the next document's beginning.

    Returns doc_id, n_chars, signatures, edited (text), edited_signatures, next_signatures. The next document has the
    next smaller id (after the smallest: the greatest); equal ids follow each other by a hash of the text, null ids come
    last. A null text counts as empty. A single row is its own next. An empty table gives an empty result.

    Texts are shuffled once: to ranges of neighbouring ids (and texts, so that one id may have any number of rows), each
    of which also receives the row with which the next range begins. The driver sees one key per range.
    """
    # Ascending keys are descending ids; null ids come last.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "doc_id", "text", F.bitwise_not(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("a"), F.xxhash64("text").alias("b"))
    found = _starts(rows.select("a", "b")) or [(0, 0)]
    n = len(found)
    starts = tuple(F.split(F.lit(",".join(str(key[i]) for key in found)), ",").cast("array<bigint>") for i in (0, 1))
    placed = rows.withColumn("_own", _position(F.col("a"), F.col("b"), starts, n))
    first = (F.get(starts[0], F.col("_own")) == F.col("a")) & (F.get(starts[1], F.col("_own")) == F.col("b"))
    own, guest = F.struct(F.col("_own").alias("range"), F.lit(0).alias("guest")), F.struct(
        F.pmod(F.col("_own") - 1, F.lit(n)).alias("range"), F.lit(1).alias("guest"))
    dealt = (placed.select("doc_id", "text", "a", "b", F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own))).alias("_to"))
             .select("doc_id", "text", "a", "b", F.col("_to.range").alias("_range"), F.col("_to.guest").alias("_guest"))
             .repartition("_range").sortWithinPartitions("_range", "_guest", "a", "b"))
    order = Window.partitionBy("_range").orderBy("_guest", "a", "b")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("_next", F.lit(1), half))
    return (dealt.withColumn("signatures", signatures(F.col("text"), anchors, chain))
            .withColumn("_next", F.lead("text").over(order)).withColumn("next_signatures", F.lead("signatures").over(order))
            .filter("_guest = 0")
            .select("doc_id", F.length("text").cast("long").alias("n_chars"), "signatures", edited.alias("edited"), "next_signatures")
            .withColumn("edited_signatures", signatures(F.col("edited"), anchors, chain)))


@query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and how alike the sets are."""
    sets = fingerprints_and_edits(table(spark, sf_dir, "documents"))
    return sets.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("signatures")).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        F.size("signatures").alias("n_signatures"))
