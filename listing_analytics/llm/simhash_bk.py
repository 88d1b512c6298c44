"""SimHash near-dedup: BK-trees over shards of the fingerprints.

Two fingerprints with at most ``radius`` differing bits agree in all bits of at least ``blocks - radius`` of ``blocks``
blocks. Each choice of that many blocks gives a shard key, so every link lies inside a shard, and a shard holds few
fingerprints. Each shard is a BK-tree in the task that it is dealt to (all fingerprints together have no size bound that
would allow a broadcast); a search follows only children whose distance to the parent is within the radius of the
query's. A shard above ``CAPACITY`` is split by a hash into trees of that size, and each of its fingerprints also visits
the trees before its own, so no task needs more than one bounded tree in memory. A tree reports one link per fingerprint
and component, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listing_analytics.llm.common import as_bytes, partitions, prepare, store, table, texts
from listing_analytics.llm.components import components
from listing_analytics.llm.registry import query

WORDS = 4
RADIUS = 4
SEED = 42
CAPACITY = 2048  # fingerprints in one tree
LEAF = 128
_CHUNK = 65536  # shingles whose bits are counted at once


def simhash(text: bytes, words: int = WORDS) -> int:
    """The signed 64-bit fingerprint: a bit is set if it is in over half of the shingles' hashes; 0 without a word."""
    parts = text.lower().split()
    if not parts:
        return 0
    plain = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    first, last = starts[:len(parts) - width + 1].tolist(), ends[width - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for at in range(0, len(first), _CHUNK):
        hashes = b"".join([digest(plain[s:e], SEED) for s, e in zip(first[at:at + _CHUNK], last[at:at + _CHUNK])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first)).view(">i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        some = list(as_bytes(batch.column(1)))
        marks = np.array([simhash(text) for text in some], dtype=np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(text, SEED) for text in some], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks), pa.array(hashes)], ["doc_id", "mark", "text_hash"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark (the fingerprint as a signed long) and text_hash (Spark's xxhash64) of every row; null is empty."""
    prepare(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(_fingerprints, "doc_id long, mark long, text_hash long")


class BKTree:
    """Fingerprints by distance to a parent. A node is a leaf list until it is full, then its first one is the parent."""

    def __init__(self, radius: int):
        self.radius, self.root = radius, [None, [], None]  # [parent, leaf numbers, children by distance]
        self.marks = np.empty(16, np.uint64)
        self.size = 0

    def insert(self, mark: np.uint64) -> int:
        if self.size == len(self.marks):
            self.marks = np.concatenate((self.marks, np.empty_like(self.marks)))
        number, self.marks[self.size] = self.size, mark
        self.size += 1
        node = self.root
        while node[2] is not None:
            node = node[2].setdefault(int(np.bitwise_count(self.marks[node[0]] ^ mark)), [None, [], None])
        node[1].append(number)
        if len(node[1]) > LEAF:
            node[0], node[2] = node[1][0], {}
            away = np.bitwise_count(self.marks[node[1][1:]] ^ self.marks[node[0]])
            for member, distance in zip(node[1][1:], away.tolist()):
                node[2].setdefault(distance, [None, [], None])[1].append(member)
            node[1] = []
        return number

    def search(self, mark: np.uint64) -> list[int]:
        """Numbers of all fingerprints within the radius."""
        found, open_nodes = [], [self.root]
        while open_nodes:
            parent, leaf, children = open_nodes.pop()
            if children is None:
                if leaf:
                    near = np.bitwise_count(self.marks[leaf] ^ mark) <= self.radius
                    if near.any():
                        found.extend(np.asarray(leaf)[near].tolist())
                continue
            away = int(np.bitwise_count(self.marks[parent] ^ mark))
            if away <= self.radius:
                found.append(parent)
            open_nodes.extend(node for distance, node in children.items() if abs(distance - away) <= self.radius)
        return found


class Shard:
    """One tree with the components of its members."""

    def __init__(self, radius: int):
        self.tree, self.parent = BKTree(radius), []

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def links(self, mark: np.uint64, member: bool) -> list[np.uint64]:
        """One member of each component within the radius; a new member joins them."""
        near = {self._root(i): i for i in self.tree.search(mark)}
        out = [self.tree.marks[i] for i in near.values()]
        if member:
            number = self.tree.insert(mark)
            self.parent.append(number)
            for root in near:
                self.parent[root] = number
        return out


def _pair(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def _links(radius: int):
    """Rows sorted by (choice, key, tree, members first) to links; a shard may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, shard = None, None
        for batch in batches:
            choice, key, tree, mark, member = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            n, mark = len(mark), mark.view(np.uint64)
            if not n:
                continue
            cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1]) | (tree[1:] != tree[:-1])) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [n]))
            # Most shards have one fingerprint; only the first and the last may continue in another batch.
            busy = np.flatnonzero(ends - starts > 1).tolist()
            left, right = [], []
            for number in dict.fromkeys([0, *busy, len(starts) - 1]):
                start, end = int(starts[number]), int(ends[number])
                name = (int(choice[start]), int(key[start]), int(tree[start]))
                if name != current:
                    current, shard = name, Shard(radius)
                for i in range(start, end):
                    for other in shard.links(mark[i], bool(member[i])):
                        left.append(mark[i])
                        right.append(other)
            if left:
                yield _pair(np.array(left, np.uint64), np.array(right, np.uint64))
    return run


def masks(blocks: int, radius: int) -> list[int]:
    """For each choice of blocks that must agree, their bits as a signed long."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    chosen = [sum(bits[i] for i in c) for c in combinations(range(blocks), blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def blocks_for(n: int, radius: int) -> int:
    """The fewest blocks for which shards of evenly spread fingerprints stay small; it only changes the work."""
    blocks = radius + 2
    while blocks < 16 and n > 8 << (64 * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def near_links(marks: DataFrame, radius: int = RADIUS, blocks: int | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Links (a, b) between the distinct ``mark`` of a stored table that connect whatever lies within the radius."""
    spark = marks.sparkSession
    prepare(spark)
    blocks = blocks or blocks_for(marks.count(), radius)
    keys = F.array(*[F.col("mark").bitwiseAND(F.lit(m)) for m in masks(blocks, radius)])
    rows = marks.select("mark", F.posexplode(keys).alias("choice", "key"))
    large = (rows.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > capacity)
             .select("choice", "key", F.ceil(F.col("n") / capacity).cast("int").alias("trees")))
    own = F.coalesce(F.pmod(F.xxhash64("mark"), F.col("trees")), F.lit(0)).cast("int")
    dealt = (rows.join(large, ["choice", "key"], "left").withColumn("own", own)
             .select("choice", "key", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("tree"), "mark", "own")
             .select("choice", "key", "tree", "mark", (F.col("tree") == F.col("own")).alias("member"))
             .repartition(partitions(spark), "choice", "key", "tree")
             .sortWithinPartitions("choice", "key", "tree", F.col("member").desc(), "mark"))
    return dealt.mapInArrow(_links(radius), "a long, b long")


def _named(rows: DataFrame, radius: int) -> DataFrame:
    """(mark, root, component_id) for every mark of the stored ``rows``; root is the least mark of the component."""
    marks, _ = store(rows.groupBy("mark").agg(F.min("doc_id").alias("first")), "marks")
    roots = components(near_links(marks, radius)).withColumnRenamed("node", "mark")
    rooted = marks.join(roots, "mark", "left").withColumn("root", F.coalesce("root", "mark"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return store(rooted.join(names, "root").select("mark", "root", "component_id"), "mark-components")[0]


def near_components(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint and the smallest id among all rows reachable over links of ``radius`` bits.

    Returns doc_id, mark, component_id. Equal texts have equal fingerprints and hence one component; texts without a
    word share fingerprint zero, which is linked like any other. Rows with a null id take part; they never name a
    component, and a component of null ids only has a null name. An empty table gives an empty result.
    """
    rows, _ = store(fingerprints(docs, id_col, text_col), "fingerprints")
    return rows.join(_named(rows, radius), "mark").select("doc_id", "mark", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the smallest id, of repeated ids the smallest text hash.

    A component of null ids only keeps one of its rows, too.
    """
    rows, _ = store(fingerprints(docs, id_col, text_col), "fingerprints")
    best = Window.partitionBy("root").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash")
    least = F.lit(-(1 << 63))
    kept = (rows.join(_named(rows, radius), "mark").withColumn("_place", F.row_number().over(best)).filter("_place = 1")
            .select(F.coalesce("doc_id", least).alias("_id"), F.col("text_hash").alias("_hash")))
    keyed = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(id_col).cast("long"), least).alias("_id"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_hash"))
    same = Window.partitionBy("_id", "_hash").orderBy("_id")
    return (keyed.join(kept, ["_id", "_hash"], "left_semi").withColumn("_copy", F.row_number().over(same))
            .filter("_copy = 1").select("_row.*"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with fingerprint and component."""
    return near_components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")
