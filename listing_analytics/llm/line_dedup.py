"""Line dedup with levelled sorted runs of line hashes.

The runs hold every line key seen so far with the document that owns it. A batch of documents is reduced to its
distinct keys, merge-joined with the runs (both sides hashed and sorted by key, the runs read as bucketed tables, so only
the batch is shuffled), and what the runs don't know becomes a run of its own. When a level has ``fanout`` runs they are
merged into one run of the next level, so a key is rewritten once per level and a batch meets a logarithmic number of
runs.

Keys are 128-bit hashes: at 10^12 distinct lines a collision has a chance of about 10^-15.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.llm.common import as_bytes, discard, let, partitions, prepare, store, table, texts
from listing_analytics.llm.registry import query
from listing_analytics.session import scratch_path

MIN_CHARS = 10
BATCHES = 4
FANOUT = 3
BLANKS = b" \t\n\v\f\r"

LINES = "h1 long, h2 long, doc_id long, text_hash long, pos int, batch int"
_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
                    ("pos", pa.int32()), ("batch", pa.int32())])


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def _line_hashes(bounds: list[int], min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            digests, at, counts, hashes, numbers = [], [], [], [], []
            for doc_id, text in zip(ids, as_bytes(batch.column(1))):
                before = len(at)
                for pos, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    # Four bytes are the most that a code point has.
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        at.append(pos)
                counts.append(len(at) - before)
                hashes.append(xxhash.xxh64_intdigest(text, seed=42))  # Spark's xxhash64
                numbers.append(bisect_right(bounds, doc_id))
            both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            spread = lambda values, kind: np.repeat(np.array(values, dtype=kind), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])),
                 pa.array(spread(ids, np.int64)), pa.array(spread(hashes, np.uint64).view(np.int64)),
                 pa.array(np.array(at, dtype=np.int32)), pa.array(spread(numbers, np.int32))], schema=_LINES)
    return run


class LineRuns:
    """The levels of runs. A run has unique keys (h1, h2) with their owner, and no key is in two runs."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.buckets = spark, fanout, partitions(spark)
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, keys: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "line-run")
        (keys.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", path).saveAsTable(name))
        return name, path

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def owners(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``owner``, null where no run has the key: the merge join with each run."""
        found = keys.withColumn("owner", F.lit(None).cast("long"))
        for number, run in enumerate(self.runs()):
            known = run.select("h1", "h2", F.col("owner").alias(f"owner_{number}")).hint("merge")
            found = (found.join(known, ["h1", "h2"], "left")
                     .withColumn("owner", F.coalesce("owner", f"owner_{number}")).drop(f"owner_{number}"))
        return found

    def add(self, fresh: DataFrame) -> None:
        """Add keys that no run has as a run, then merge every level that has become full into the next."""
        depth, run = 0, self._write(fresh.select("h1", "h2", "owner"))
        while True:
            if depth == len(self.levels):
                self.levels.append([])
            self.levels[depth].append(run)
            if len(self.levels[depth]) < self.fanout:
                return
            full, self.levels[depth] = self.levels[depth], []
            merged = self.spark.table(full[0][0])
            for name, _ in full[1:]:
                merged = merged.union(self.spark.table(name))
            run = self._write(merged)
            self._drop(full)
            depth += 1

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"drop table {name}")
            discard(self.spark, path)

    def close(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = []


def repeated_lines(lines: DataFrame, runs: LineRuns) -> tuple[DataFrame, str]:
    """Rows of ``lines`` (one batch) that go: their key has an owner, in the runs or in this batch, elsewhere.

    The batch's new keys are added to the runs. Copies of one line meet first in a partial aggregation; the join back
    is a sort-merge join of which adaptive execution splits partitions that one line has made large.
    """
    keys = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    known, path = store(runs.owners(keys), "line-keys")
    runs.add(known.filter("owner is null").select("h1", "h2", F.col("first").alias("owner")))
    shared = known.filter("owner is not null or first <> last").select("h1", "h2", F.coalesce("owner", "first").alias("owner"))
    gone, gone_path = store(lines.join(shared.hint("merge"), ["h1", "h2"]).filter("doc_id <> owner")
                            .select("doc_id", "text_hash", "pos"), "line-drops")
    discard(lines.sparkSession, path)
    return gone, gone_path


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT,
                id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Lines found in two documents or more stay only in the smallest id that holds them.

    Returns doc_id, kept (text), n_lines, n_dropped (and carried, a struct of the columns in ``carry``) per input row. ``batches`` ranges of the id go through the
    runs in ascending order, so the owner found first is the smallest id. Keys shorter than ``min_chars`` code points
    are never dropped. A null or empty text is one empty line. Rows with the same id are one document: a line repeated
    inside it stays everywhere in it. Rows without an id keep all their lines and own none. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = texts(docs, id_col, text_col, carry)
    parts = [i / batches for i in range(1, batches)]
    cuts = (source.select(F.percentile_approx("doc_id", parts, 10000)).first()[0] or []) if parts else []
    lines, lines_path = store(source.select("doc_id", "text").filter("doc_id is not null").mapInArrow(_line_hashes(sorted(set(cuts)), min_chars), LINES),
                              "lines", "batch")
    runs, gone = LineRuns(spark, fanout), []
    try:
        for number in range(len(set(cuts)) + 1):
            gone.append(repeated_lines(lines.filter(F.col("batch") == number).drop("batch"), runs)[0])
    finally:
        runs.close()
        discard(spark, lines_path)
    drops = gone[0]
    for more in gone[1:]:
        drops = drops.union(more)
    drops = drops.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("drops"))
    joined = source.withColumn("text_hash", F.xxhash64("text")).join(drops, ["doc_id", "text_hash"], "left")
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    kept = let(F.split("text", "\n", -1), lambda line: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(line) - 1), F.col("drops")), lambda i: F.get(line, i)), "\n"))
    return joined.select("doc_id", F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias("kept"),
                         n_lines.cast("long").alias("n_lines"),
                         F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
                         *([] if carry is None else ["carried"]))


SQL = """
with line as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents))),
owner as (
  select key, min(doc_id) as doc_id from line where length(key) >= 10 group by key having count(distinct doc_id) > 1),
judged as (
  select line.*, owner.key is not null and owner.doc_id <> line.doc_id as gone
  from line left join owner on line.key = owner.key)
select doc_id, count(*) as n_lines, cast(sum(cast(gone as int)) as bigint) as n_dropped,
       sha256(coalesce(string_agg(case when not gone then line end, chr(10) order by pos), '')) as kept_sha256
from judged group by doc_id"""


@query("op1_line_dedup", SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines before, lines dropped, SHA-256 of what stays."""
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
