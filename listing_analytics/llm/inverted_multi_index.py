"""Approximate nearest neighbours by inner product with an inverted multi-index.

Both halves of the vectors are quantised separately, so K centroids each give K x K cells. A query walks the cells by
the summed products of its halves with the centroids, best first: a heap holds the next candidates among the pairs. It
stops when the cells hold ``probe`` of all distinct vectors, and some times as many as are wanted at least. The vectors in
those cells are compared exactly.

Cells are packed into blocks of bounded size. Every vector is shuffled once, to its block, and a query to the blocks that
it wants cells of. A task keeps its block and lets the queries stream past it, cell by cell with those that want the
cell. Of equal vectors only the k + 1 with the smallest ids can be among anyone's k
nearest, so the others are left out before the shuffle; a vector that a third of all rows share costs no more than any.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listing_analytics.llm.common import partitions, prepare, store, table
from listing_analytics.llm.registry import query

NEAREST = 20
CENTROIDS = 64
PROBE = 0.55
SAMPLE = 16384  # vectors that the quantisers are fitted on
ROUNDS = 10
BLOCK = 65536  # vectors of a block at most, but for a cell's rest; there are as many blocks as shuffle partitions at least
FLOOR = 10  # a query visits cells with this many times the wanted vectors
STREAM = 128  # queries that are compared at once

SCHEMA = "query_id long, rank int, vec_id long, score double"
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame, dim: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Distinct (vec_id, vector) with an id and finite components that aren't all zero.

    Vectors of another length than ``dim`` are left out, by default than the commonest length (of several, the greatest).
    Float components stay floats, any others become doubles. Null vectors, null ids and vectors with null components are left
    out; other columns are not read, so their names cannot clash.
    """
    v = F.col("vector")
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    fine = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0)
                       & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if dim is None:
        sizes = fine.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
        dim = sizes["n"] if sizes else 0
    return fine.filter(F.size(v) == dim).distinct()


def _array(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def quantiser(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of a half by Lloyd's rounds, begun at evenly spaced points of the sample."""
    centroids = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        near = nearest_centroid(points, centroids)
        for c in range(len(centroids)):
            if (near == c).any():
                centroids[c] = points[near == c].mean(axis=0)
    return centroids


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids ** 2).sum(axis=1) - 2 * points @ centroids.T, axis=1)


def best_first(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: float) -> list[int]:
    """Cells by descending sum of both halves' products until their ``counts`` come to ``enough``."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y, k = first[a].tolist(), second[b].tolist(), len(second)
    a, b = a.tolist(), b.tolist()
    heap, cells, got = [(-x[0] - y[0], 0, 0)], [], 0
    while heap and got < enough:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * k + b[j]
        if counts[cell]:
            cells.append(cell)
            got += counts[cell]
        # Every pair is pushed once: along the second list always, along the first only from its beginning.
        if j + 1 < len(b):
            heapq.heappush(heap, (-x[i] - y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-x[i + 1] - y[0], i + 1, 0))
    return cells


class MultiIndex:
    """The quantisers, the number of distinct vectors in each cell, and the blocks that the cells are packed into."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = first.shape[1]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return (nearest_centroid(vectors[:, :self.half], self.first) * len(self.second)
                + nearest_centroid(vectors[:, self.half:], self.second))

    def pack(self, counts: dict[int, int], rows: dict[int, int], block: int) -> None:
        """Blocks of neighbouring cells, about ``block`` rows each; a larger cell is split over several blocks."""
        self.counts = np.zeros(len(self.first) * len(self.second), np.int64)
        self.blocks: dict[int, tuple[int, int]] = {}  # cell: first block, number of blocks
        number, size = 0, 0
        for cell in sorted(rows):
            self.counts[cell] = counts.get(cell, 0)
            parts = -(-rows[cell] // block)
            if size and size + rows[cell] > block:
                number, size = number + 1, 0
            self.blocks[cell] = (number, parts)
            if parts > 1:
                number, size = number + parts, 0
            else:
                size += rows[cell]

        self.size = number + 1

    def wanted(self, vector: np.ndarray, enough: float) -> dict[int, list[int]]:
        """The cells that a query visits to meet ``enough`` distinct vectors, by block."""
        by_block: dict[int, list[int]] = {}
        for cell in best_first(self.first @ vector[:self.half], self.second @ vector[self.half:], self.counts, enough):
            start, parts = self.blocks[cell]
            for block in range(start, start + parts):
                by_block.setdefault(block, []).append(cell)
        return by_block


def _nearest(own: np.ndarray, q: np.ndarray, who: np.ndarray, what: np.ndarray, block: tuple, k: int) -> list[np.ndarray]:
    """query_id, vec_id and exact score of the k nearest of a block for some queries; ties go to the smaller id.

    ``who`` wants the cells ``what``. A matrix product finds the candidates, with a margin for its rounding.
    """
    ids, cells, e, longest = block
    scores = np.full((len(q), len(e)), -np.inf)
    names, starts = np.unique(cells, return_index=True)
    for name, start, end in zip(names, starts, [*starts[1:], len(e)]):
        some = who[what == name]
        if len(some):
            scores[some, start:end] = q[some] @ e[start:end].T
    scores[own[:, None] == ids[None, :]] = -np.inf
    least = np.partition(scores, len(e) - k, axis=1)[:, len(e) - k] if len(e) > k else np.full(len(q), -np.inf)
    margin = 4 * q.shape[1] * np.finfo(np.float64).eps * longest * np.sqrt((q * q).sum(axis=1))
    row, col = np.nonzero((scores >= (least - margin)[:, None]) & (scores > -np.inf))
    exact = (q[row] * e[col]).sum(axis=1)  # alike for equal vectors, unlike a matrix product
    order = np.lexsort((ids[col], -exact, row))
    row, col, exact = row[order], col[order], exact[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return [own[row][place < k], ids[col][place < k], exact[place < k]]


def _block(parts: list[pa.RecordBatch]) -> tuple:
    """Ids, cells and vectors of a block by cell and id, and the length of its longest vector."""
    whole = pa.Table.from_batches(parts).combine_chunks()
    ids, cells = whole["id"].to_numpy(), whole["cells"].chunk(0).flatten().to_numpy() if len(whole) else np.array([], np.int32)
    e = _array(whole["vector"].chunk(0)).astype(np.float64)
    order = np.lexsort((ids, cells))
    e = e[order]
    return ids[order], cells[order], e, float(np.sqrt((e * e).sum(axis=1).max()))


def _compare(k: int):
    """Rows sorted by (key, asks): of each key first the block's entries, which are kept, then the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, entries, block = None, [], None
        for batch in batches:
            keys, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(batch)]):
                if start == end:
                    continue
                if keys[start] != key:
                    key, entries, block = keys[start], [], None
                if not asks[start]:
                    entries.append(batch.slice(start, end - start))
                    continue
                if block is None and entries:
                    block, entries = _block(entries), []
                if block is None:
                    continue
                for at in range(start, end, STREAM):
                    part = batch.slice(at, min(STREAM, end - at))
                    lists = part.column(3)
                    who = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy(zero_copy_only=False))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in _nearest(
                        part.column(2).to_numpy(), _array(part.column(4)).astype(np.float64), who,
                        lists.flatten().to_numpy(), block, k)], schema=_FOUND)
    return run


def _keys(spark: SparkSession, n: int) -> DataFrame:
    """(block, key) for n blocks: keys that a hash deals to n different partitions, so that no task has two blocks."""
    tried = spark.range(n * 64).select(F.pmod(F.hash("id"), F.lit(n)).alias("part"), "id")
    found = [r["key"] for r in tried.groupBy("part").agg(F.min("id").alias("key")).collect()]  # n rows at most
    return spark.createDataFrame(list(enumerate([*found, *range(n * 64, n * 65 - len(found))])), "block int, key long")


def build(vectors: DataFrame, k: int = NEAREST, centroids: int = CENTROIDS, block: int = BLOCK, sample: int = SAMPLE) -> tuple[MultiIndex | None, DataFrame]:
    """The index over all of ``usable`` vectors and its entries (block, cell, vec_id, vector).

    The quantisers are fitted on the ``sample`` vectors whose ids have the smallest hashes; every vector is filed.
    """
    spark = vectors.sparkSession
    prepare(spark)
    points = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()["vector"].combine_chunks()
    points = _array(points).astype(np.float64)
    if not len(points):
        return None, vectors.select(F.lit(0).alias("block"), F.lit(0).alias("cell"), "vec_id", "vector")
    half = points.shape[1] // 2
    index = MultiIndex(quantiser(points[:, :half], centroids), quantiser(points[:, half:], centroids))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    kept = vectors.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cells = index.cells(_array(batch.column(1)).astype(np.float64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cells), *batch.columns], ["cell", "vec_id", "vector", "copy"])

    kind = vectors.schema["vector"].dataType.simpleString()
    filed, _ = store(kept.select("vec_id", "vector", "copy").mapInArrow(file, f"cell int, vec_id long, vector {kind}, copy int"), "multi-index")
    tally = filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("copy") == 1).alias("d")).collect()  # K x K rows at most
    total = sum(r["n"] for r in tally)
    index.pack({r["cell"]: r["d"] for r in tally}, {r["cell"]: r["n"] for r in tally},
               max(1, min(block, -(-total // partitions(spark)))))
    places = spark.createDataFrame([(cell, start, parts) for cell, (start, parts) in index.blocks.items()],
                                   "cell int, start int, parts int")  # as many rows as cells
    spread = (F.col("start") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int")
    return index, filed.join(F.broadcast(places), "cell").select(spread.alias("block"), "cell", "vec_id", "vector")


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, probe: float = PROBE, centroids: int = CENTROIDS,
           block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """The k nearest found for every row of ``queries`` among ``vectors``, without the rows of the query's own id.

    Both tables are ``usable`` ones (vec_id, vector) with vectors of one length and kind. Returns query_id, rank, vec_id,
    score (inner product in double precision); ties go to the smaller id. A query meets ``probe`` of all distinct vectors and
    FLOOR times k at least, so all of them where there aren't more. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    index, entries = build(vectors, k, centroids, block, sample)
    if index is None:
        return spark.createDataFrame([], SCHEMA)
    enough = max(probe * int(index.counts.sum()), FLOOR * k)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, blocks, cells = [], [], []
            for i, vector in enumerate(_array(batch.column(1)).astype(np.float64)):
                for number, wanted in index.wanted(vector, enough).items():
                    at.append(i)
                    blocks.append(number)
                    cells.append(wanted)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), taken.column(0), pa.array(cells, pa.list_(pa.int32())),
                                              taken.column(1)], ["block", "id", "cells", "vector"])

    kind = vectors.schema["vector"].dataType.simpleString()
    asked = queries.select("vec_id", "vector").mapInArrow(plan, f"block int, id long, cells array<int>, vector {kind}")
    offered = entries.select("block", F.col("vec_id").alias("id"), F.array("cell").alias("cells"), "vector")
    rows = offered.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    found = (rows.join(F.broadcast(_keys(spark, index.size)), "block").select("key", "asks", "id", "cells", "vector")
             .repartition(index.size, "key").sortWithinPartitions("key", "asks")
             .mapInArrow(_compare(k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op8_nearest")
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors, _ = store(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))
