"""Logistic regression whose coefficients stay in a table.

The objective is the sum of the rows' losses plus half the squared length of the coefficients. Every vector that a
search from zero meets is a combination of rows, so it can be kept as one number per row and score, and as its products
with all rows. Those are the only things that need the data: one pass per step, in which each task holds some terms,
sums its rows per term and hands the sums back to the rows. Lengths, directions and line searches follow from the two
kept forms, on the driver, whose state is bounded by the number of rows and not by the vocabulary.

Where there are fewer terms than rows, the search keeps one number per term and score instead, and each task holds some
rows. So no row is left out, and the state of the driver is bounded by the smaller of both numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_analytics.session import ship_package

# Steps that the search remembers, by four numbers of single precision per row and score each, and the most such numbers that it holds.
HISTORY, _HELD = 40, 1 << 27


# Entries of the matrix that are handled at once, and rows whose sums travel together.
_BLOCK, _CHUNK = 1 << 18, 1 << 14


def _block(term: pa.Array, row: pa.Array, tf: pa.Array, n: int) -> pa.RecordBatch:
    """Entries sorted by term as one row: the terms, their numbers of rows, and rows and weights end to end."""
    starts = np.flatnonzero(np.r_[True, pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)])
    counts = np.diff(np.r_[starts, len(term)])
    weights = tf.to_numpy() * np.repeat(idf_of(counts, n), counts)
    terms = pa.ListArray.from_arrays(pa.array([0, len(starts)], pa.int32()), term.take(pa.array(starts)))
    packed = [pa.array([a.tobytes()], pa.binary()) for a in (counts.astype(np.int64), row.to_numpy().astype(np.int32), weights)]
    return pa.RecordBatch.from_arrays([terms, *packed], ["terms", "counts", "rows", "weights"])


def idf_of(counts: np.ndarray, n: int) -> np.ndarray:
    return np.log((n + 1.0) / (counts + 1.0)) + 1


def _packed(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Blocks of whole terms of a partition, which is sorted by term."""
    held: list[list[pa.Array]] = []
    for batch in batches:
        if batch.num_rows:
            held.append(list(batch.columns))
        if sum(len(h[0]) for h in held) < _BLOCK:
            continue
        term, row, tf = (pa.concat_arrays(c) for c in zip(*held))
        last = int(np.flatnonzero(pc.equal(term, term[-1]).to_numpy(zero_copy_only=False))[0])
        if last:
            yield _block(term[:last], row[:last], tf[:last], n)
        held = [[term[last:], row[last:], tf[last:]]]
    if held:
        yield _block(*(pa.concat_arrays(c) for c in zip(*held)), n)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(terms, counts, first entries, rows, weights) of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            counts, rows, weights = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in ((1, np.int64), (2, np.int32), (3, np.float64)))
            yield batch.column(0)[i].values, counts, np.cumsum(counts) - counts, rows, weights


def _summed(blocks: DataFrame, shape: tuple[int, int], add: Callable[[np.ndarray, Iterator[pa.RecordBatch]], None]) -> np.ndarray:
    """What ``add`` adds to zeros of ``shape`` in each task, summed over the tasks in parts of ``_CHUNK`` lines."""
    n, k = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        out = np.zeros(shape)
        add(out, chain([first], batches))
        for i, start in enumerate(range(0, n, _CHUNK)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([out[start:start + _CHUNK].tobytes()], pa.binary())], ["part", "sums"])

    def total(table: pa.Table) -> pa.Table:
        found = sum(np.frombuffer(s.as_buffer(), np.float64) for s in table.column("sums"))
        return pa.table({"part": table.column("part")[:1], "sums": pa.array([found.tobytes()], pa.binary())})

    schema = "part int, sums binary"
    result = np.zeros(shape)
    for r in blocks.mapInArrow(run, schema).groupBy("part").applyInArrow(total, schema).collect():
        at = r["part"] * _CHUNK
        result[at:at + _CHUNK] = np.frombuffer(r["sums"], np.float64).reshape(-1, k)
    return result


class TermMatrix:
    """TF-IDF weights of rows 0 to n-1 from (row, term, tf), each row of length one.

    Entries are dealt out by term, once, and kept in the executors as a few packed blocks while it is open. They are kept as
    they are before the rows get length one; lengths are a number per row.
    """

    def __init__(self, entries: DataFrame, n: int):
        self.spark, self.n = entries.sparkSession, n
        ship_package(self.spark)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = entries.select("term", "row", "tf").repartition(parts, "term").sortWithinPartitions("term", "row")
        packed = dealt.mapInArrow(lambda batches: _packed(batches, n), "terms array<string>, counts binary, rows binary, weights binary")
        # Each task of a pass hands on a number per row, so there are no more tasks than run at once.
        self.blocks = packed.coalesce(min(parts, self.spark.sparkContext.defaultParallelism)).persist()
        squares = self._summed(1, lambda out, first, counts, rows, weights: out.__iadd__(
            np.bincount(rows, weights * weights, minlength=n)[:, None]))
        self.shorten = 1 / np.sqrt(np.where(squares > 0, squares, 1.0))

    def __enter__(self) -> TermMatrix:
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()

    def _summed(self, k: int, add: Callable) -> np.ndarray:
        """What ``add`` adds to k numbers per row for each block, summed over the tasks."""

        def run(out: np.ndarray, batches: Iterator[pa.RecordBatch]) -> None:
            for _, counts, first, rows, weights in _unpacked(batches):
                add(out, first, counts, rows, weights)

        return _summed(self.blocks, (self.n, k), run)

    def product(self, vector: np.ndarray) -> np.ndarray:
        """For every row its product with the combination of rows that ``vector`` (rows x scores) stands for."""
        n, k = vector.shape
        shared = self.spark.sparkContext.broadcast(vector * self.shorten)

        def add(out: np.ndarray, first: np.ndarray, counts: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> None:
            for i in range(k):
                sums = np.add.reduceat(weights * shared.value[rows, i], first)
                out[:, i] += np.bincount(rows, weights * np.repeat(sums, counts), minlength=n)

        result = self._summed(k, add) * self.shorten
        shared.unpersist()
        return result

    def transposed(self, vector: np.ndarray) -> DataFrame:
        """(term, idf, coefficients) of the combination of rows that ``vector`` stands for."""
        n, k = vector.shape
        shared = self.spark.sparkContext.broadcast(vector * self.shorten)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for terms, counts, first, rows, weights in _unpacked(batches):
                sums = np.empty((len(first), k))
                for i in range(k):
                    sums[:, i] = np.add.reduceat(weights * shared.value[rows, i], first)
                ends = np.arange(len(first) + 1, dtype=np.int32) * k
                yield pa.RecordBatch.from_arrays(
                    [terms, pa.array(idf_of(counts, n)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sums.ravel()))],
                    ["term", "idf", "coefficients"])

        return self.blocks.mapInArrow(run, "term string, idf double, coefficients array<double>")


def _row_block(held: list[pa.RecordBatch], terms: pa.Array, idf: np.ndarray) -> pa.RecordBatch:
    """Rows (label, terms) as one row: labels, numbers of terms, terms and how often they are there, and what makes the rows length one."""
    label, lists = (pa.concat_arrays([b.column(i) for b in held]) for i in range(2))
    pairs, counts = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    ids = pc.index_in(pairs.field("term"), value_set=terms).to_numpy()
    tf = pairs.field("tf").to_numpy()
    squares = np.bincount(np.repeat(np.arange(len(counts)), counts), (tf * idf[ids]) ** 2, minlength=len(counts))
    tf = tf.astype(np.uint8 if tf.max(initial=0) < 256 else np.int64)
    packed = label.to_numpy().astype(np.int32), counts.astype(np.int32), ids.astype(np.int32), tf, 1 / np.sqrt(np.where(squares > 0, squares, 1.0))
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in packed], ["labels", "counts", "ids", "tf", "shorten"])


def _slopes_of(label: pa.Buffer, counts: pa.Buffer, ids: pa.Buffer, tf: pa.Buffer, shorten: pa.Buffer, weights: np.ndarray,
               free: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Adds what the rows of a block give to the sums (scores x terms); returns the slopes by the intercepts.

    A number per row and score lies score by score in memory, as there are many rows and few scores.
    """
    label, counts, ids = (np.frombuffer(a, np.int32) for a in (label, counts, ids))
    shorten, k = np.frombuffer(shorten, np.float64), len(free)
    once = tf.size == len(ids) and not np.any(np.frombuffer(tf, np.uint8) > 1)
    tf = np.float64(1) if once else np.frombuffer(tf, np.uint8 if tf.size == len(ids) else np.int64).astype(np.float64)
    some = counts > 0
    first = (np.cumsum(counts, dtype=np.int64) - counts)[some]
    z = np.zeros((k, len(counts)))
    for s in range(k if len(ids) else 0):
        z[s, some] = np.add.reduceat(weights[s].take(ids) * tf, first)
    error = chances((z * shorten).T + free) - own_class(label, k)
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    for s in range(k):
        sums[s] += np.bincount(ids, (shorten * error[:, s]).take(row) * tf, minlength=sums.shape[1])
    return error.sum(axis=0)


class RowMatrix:
    """TF-IDF weights of rows (label, terms), each row of length one; label is the number of the row's class.

    Rows stay where they are read and are kept in the executors as packed blocks while it is open. ``terms`` are all terms
    of the rows, known to every task by their places, and ``idf`` their weights.
    """

    def __init__(self, rows: DataFrame, terms: pa.Array, idf: np.ndarray, scores: int):
        self.spark, self.scores, self.idf = rows.sparkSession, scores, idf
        ship_package(self.spark)
        known = self.known = self.spark.sparkContext.broadcast((terms, idf))
        enough = max(_BLOCK, len(terms))  # finding the places of terms takes a pass over all of them

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, entries = [], 0
            for batch in batches:
                held.append(batch)
                entries += len(batch.column(1).flatten()) + batch.num_rows
                if entries >= enough:
                    yield _row_block(held, *known.value)
                    held, entries = [], 0
            if held:
                yield _row_block(held, *known.value)

        packed = rows.select("label", "terms").mapInArrow(run, "labels binary, counts binary, ids binary, tf binary, shorten binary")
        # The files of the rows may be few or unequal; the blocks are alike.
        self.blocks = packed.repartition(self.spark.sparkContext.defaultParallelism).persist()

    def __enter__(self) -> RowMatrix:
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()
        self.known.unpersist()

    def slopes(self, coefficients: np.ndarray, intercepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gradient of the rows' losses by the coefficients (terms x scores) and by the intercepts."""
        size, k = coefficients.shape
        shared = self.spark.sparkContext.broadcast(((coefficients * self.idf[:, None]).T.copy(), intercepts))

        def run(out: np.ndarray, batches: Iterator[pa.RecordBatch]) -> None:
            sums = np.zeros((k, size))
            for batch in batches:
                for i in range(batch.num_rows):
                    out[size] += _slopes_of(*(batch.column(c)[i].as_buffer() for c in range(5)), *shared.value, sums)
            out[:size] = sums.T

        found = _summed(self.blocks, (size + 1, k), run)
        shared.unpersist()
        return found[:size] * self.idf[:, None], found[size]


def own_class(label: np.ndarray, scores: int) -> np.ndarray:
    """1 in the column of each row's class; a single score is that of class 1."""
    return ((np.array([1]) if scores == 1 else np.arange(scores))[:, None] == label).astype(np.float64).T


def chances(z: np.ndarray) -> np.ndarray:
    """Probabilities by score: of the one event for a single score, else of each class."""
    if z.shape[1] == 1:
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Vector:
    """A direction: a combination of rows, its products with the rows, and the part of the intercepts.

    In the space of the terms both are the coefficients.
    """

    def __init__(self, rows: np.ndarray, products: np.ndarray, free: np.ndarray):
        self.rows, self.products, self.free = rows, products, free

    def plus(self, other: _Vector, times: float) -> _Vector:
        rows = self.rows + times * other.rows
        alone = self.products is self.rows and other.products is other.rows
        return _Vector(rows, rows if alone else self.products + times * other.products, self.free + times * other.free)

    def slim(self) -> _Vector:
        """The same at single precision: what past steps say about the curvature needs no more."""
        rows = self.rows.astype(np.float32)
        return _Vector(rows, rows if self.products is self.rows else self.products.astype(np.float32), self.free)

    def dot(self, other: _Vector) -> float:
        return float((self.rows * other.products).sum() + self.free @ other.free)


def _remembered(history: list[tuple[_Vector, _Vector]], step: _Vector, change: _Vector) -> list[tuple[_Vector, _Vector]]:
    """The last steps with a further one, unless that says nothing about the curvature."""
    if step.dot(change) <= 1e-12 * change.dot(change):
        return history
    return [*history, (step.slim(), change.slim())][-min(HISTORY, max(_HELD // (4 * max(step.rows.size, 1)), 8)):]


def _direction(gradient: _Vector, history: list[tuple[_Vector, _Vector]]) -> _Vector:
    """Limited-memory BFGS: the gradient turned by the last steps and the changes of the gradient on them."""
    found, factors = gradient.plus(gradient, -2.0), []
    for step, change in reversed(history):
        factors.append(step.dot(found) / step.dot(change))
        found = found.plus(change, -factors[-1])
    if history:
        step, change = history[-1]
        found = found.plus(found, step.dot(change) / change.dot(change) - 1)
    for (step, change), factor in zip(history, reversed(factors)):
        found = found.plus(step, factor - change.dot(found) / step.dot(change))
    return found


def fit_by_rows(product: Callable[[np.ndarray], np.ndarray], y: np.ndarray, tol: float, max_passes: int) -> tuple[np.ndarray, np.ndarray]:
    """The optimum as (rows x scores, intercepts); the coefficients are the sum of the rows times those numbers.

    ``y`` has a column per score, 1 where the row is of that class. No score (a single class) needs no search.
    """
    n, k = y.shape
    at = _Vector(np.zeros((n, k)), np.zeros((n, k)), np.zeros(k))
    history: list[tuple[_Vector, _Vector]] = []
    before = last_step = None
    for _ in range(max_passes if k else 0):
        error = chances(at.products + at.free) - y
        gradient = _Vector(error + at.rows, product(error) + at.products, error.sum(axis=0))
        # Of rows that depend on each other the length of a short vector can come out below zero.
        if max(gradient.dot(gradient), 0.0) ** 0.5 <= tol * n:
            break
        if before is not None:
            history = _remembered(history, last_step, gradient.plus(before, -1.0))
        # At first a step that the curvature of a mean row allows.
        direction = _direction(gradient, history) if history else gradient.plus(gradient, -1 - 1 / n)
        slope_at = lambda t: float((  # noqa: E731, B023
            (chances(at.products + at.free + t * (direction.products + direction.free)) - y) * (direction.products + direction.free)).sum()
            + at.plus(direction, t).rows.ravel() @ direction.products.ravel())
        low, high, start = 0.0, 1.0, abs(slope_at(0.0))
        middle, slope = high, slope_at(high)
        while slope < -0.05 * start and high < 2 ** 40:
            low, high = high, high * 2
            middle, slope = high, slope_at(high)
        for _ in range(60):
            if abs(slope) <= 0.05 * start:
                break
            middle = (low + high) / 2
            slope = slope_at(middle)
            low, high = (middle, high) if slope < 0 else (low, middle)
        before, last_step = gradient, direction.plus(direction, middle - 1)
        at = at.plus(last_step, 1.0)
    return at.rows, at.free


def fit_by_terms(slopes: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], terms: int, scores: int, n: int,
                 tol: float, max_passes: int) -> tuple[np.ndarray, np.ndarray]:
    """The optimum as (coefficients, intercepts), for ``n`` rows; the same search as in :func:`fit_by_rows`.

    A line search costs a pass for each point that it tries, so the first one that shortens the slope enough is taken.
    """

    def gradient_at(at: _Vector) -> _Vector:
        by_terms, free = slopes(at.rows, at.free)
        by_terms = by_terms + at.rows
        return _Vector(by_terms, by_terms, free)

    zero = np.zeros((terms, scores))
    at = _Vector(zero, zero, np.zeros(scores))
    history: list[tuple[_Vector, _Vector]] = []
    passes = 1
    gradient = gradient_at(at) if scores else at
    while gradient.dot(gradient) ** 0.5 > tol * n and passes < max_passes:
        direction = _direction(gradient, history) if history else gradient.plus(gradient, -1 - 1 / n)
        start, low, high, t = gradient.dot(direction), (0.0, gradient.dot(direction)), None, 1.0
        while True:
            there = at.plus(direction, t)
            found = gradient_at(there)
            passes += 1
            slope = found.dot(direction)
            if 0.9 * start <= slope <= -0.5 * start or passes >= max_passes:
                break
            low, high = ((t, slope), high) if slope < 0 else (low, (t, slope))
            # Where the line through two slopes meets zero; outside of what was tried not too near and not too far.
            a, b = (low, high) if high else ((0.0, start), low)
            zero_at = a[0] - a[1] * (b[0] - a[0]) / (b[1] - a[1]) if b[1] > a[1] else np.inf
            near, far = (a[0] + 0.05 * (b[0] - a[0]), b[0] - 0.05 * (b[0] - a[0])) if high else (2 * t, 64 * t)
            t = float(min(max(zero_at, near), far))
        history = _remembered(history, direction.plus(direction, t - 1), found.plus(gradient, -1.0))
        at, gradient = there, found
    return at.rows, at.free
