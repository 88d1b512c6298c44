"""Large text files in pieces that many tasks read, with what a piece's beginning depends on carried along the file.

A file is cut at every separator, whatever it stands in. What a separator means depends on the text before it: is it
inside quotes, how deep are the brackets. That is the sum of what each piece changes, so it is found by running sums
inside the blocks that Spark reads the file in, and by a running sum over the blocks of a file, of which there is one per
block of input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_analytics.session import ship_package, store


@dataclass(frozen=True)
class Step:
    """What a piece does: is its end inside quotes, and how many brackets does it open, each for a piece that begins
    outside and for one that begins inside quotes."""

    inside_from_outside: Column
    inside_from_inside: Column
    opens_from_outside: Column
    opens_from_inside: Column


def _scan(spark: SparkSession, path: str | list[str], separator: str, step: Callable[[Column], Step]) -> DataFrame:
    """The pieces in the order of their blocks."""
    rows = spark.read.option("lineSep", separator).text(path).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"))
    does = step(F.col("value"))
    return rows.select("*", does.inside_from_outside.cast("byte").alias("e0"), does.inside_from_inside.cast("byte").alias("e1"),
                       does.opens_from_outside.cast("long").alias("d0"), does.opens_from_inside.cast("long").alias("d1"))


def _before(by: list[str], order: str, and_here: bool = False):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if and_here else -1)


def _state(rows: DataFrame, by: list[str], order: str, first: dict[str, Column]) -> DataFrame:
    """``rows`` with the state (0 outside, 1 inside) before each, for every given state before the first.

    A row that ends the same way from both states decides alone what follows; the others keep the state or change it.
    """
    flips = F.when((F.col("e0") == 1) & (F.col("e1") == 0), 1).otherwise(0)
    counted = rows.withColumn("_flips", F.sum(flips).over(_before(by, order, True)))
    decided = F.last(F.when(F.col("e0") == F.col("e1"), F.col("e0") + F.col("_flips")), ignorenulls=True).over(_before(by, order))
    flipped = F.coalesce(F.lag("_flips").over(Window.partitionBy(*by).orderBy(order)), F.lit(0))
    return counted.withColumns({name: (F.coalesce(decided, start) + flipped) % 2 for name, start in first.items()}).drop("_flips")


class _Walk:
    """State and depth along the pieces of a block, some of them at a time, as ``_state`` has them along the blocks."""

    def __init__(self, state: int, depth: int = 0) -> None:
        self.state, self.depth = state, depth

    def on(self, e0: np.ndarray, e1: np.ndarray, d0: np.ndarray, d1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and depth before each of the next pieces."""
        flips = np.cumsum((e0 == 1) & (e1 == 0))
        decided = np.maximum.accumulate(np.where(e0 == e1, np.arange(len(e0)), -1))
        after = np.where(decided >= 0, e0[decided] + flips - flips[decided], self.state + flips) % 2
        before = np.r_[self.state, after[:-1]]
        change = np.where(before == 0, d0, d1)
        depth = self.depth + np.cumsum(change)
        self.state, self.depth = int(after[-1]), int(depth[-1])
        return before, depth - change


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def _runs(changed: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the rows of one block each; ``changed`` says where a row is of another block than the one before."""
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(changed) + 1]
    return zip(edges, edges[1:])


_CHANGE = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("block", T.LongType()), *[
    T.StructField(name, T.LongType()) for name in ("e0", "e1", "d0", "d1")]])


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does as a whole; blocks lie one after the other."""
    at, walks = None, ()

    def done() -> pa.RecordBatch:
        (outside, inside) = walks
        row = [*at, outside.state, inside.state, outside.depth, inside.depth]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if i == 0 else pa.int64()) for i, v in enumerate(row)], names=_CHANGE.fieldNames())

    for batch in batches:
        if not len(batch):
            continue
        files, blocks = batch.column("source_file"), batch.column("block").to_numpy()
        does = _numbers(batch, "e0", "e1", "d0", "d1")
        changed = (blocks[1:] != blocks[:-1]) | pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
        for start, end in _runs(changed):
            here = (files[start].as_py(), int(blocks[start]))
            if here != at:
                if at is not None:
                    yield done()
                at, walks = here, (_Walk(0), _Walk(1))
            for walk in walks:
                walk.on(*(d[start:end] for d in does))
    if at is not None:
        yield done()


def _blocks(spark: SparkSession, path: str | list[str], separator: str, step: Callable[[Column], Step]) -> DataFrame:
    """State and depth before each block: (source_file, block, no, state_in, depth_in). No text is moved."""
    blocks = _scan(spark, path, separator, step).drop("value").mapInArrow(_changes, _CHANGE)
    known = _state(blocks, ["source_file"], "block", {"state_in": F.lit(0)})
    change = F.when(F.col("state_in") == 0, F.col("d0")).otherwise(F.col("d1"))
    depth = F.coalesce(F.sum(change).over(_before(["source_file"], "block")), F.lit(0))
    return store(known.withColumn("depth_in", depth).select(
        "source_file", "block", F.monotonically_increasing_id().alias("no"), "state_in", "depth_in"), "blocks")


_GROUP = T.StructType([T.StructField("no", T.LongType()), T.StructField("at", T.LongType()), T.StructField("own", T.LongType()),
                       T.StructField("whole", T.BooleanType()), T.StructField("value", T.StringType())])


def _groups(separator: str, starts: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable:
    """Joins pieces inside their blocks. What comes before the first start of a block has no ``own``; that and its last group,
    which may go on in the next block, are not ``whole``."""

    def rows(no: int, at: np.ndarray, own: list[int | None], whole: bool, values: pa.Array) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, no)), pa.array(at, pa.int64()), pa.array(own, pa.int64()), pa.array(np.full(n, whole)), values], names=_GROUP.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, walk, at, own, opened, parts = None, None, 0, None, 0, []
        joined = lambda: separator.join(v for part in parts for v in part.to_pylist())

        def part_row(whole: bool) -> pa.RecordBatch:
            return rows(no, np.array([opened]), [own], whole, pa.array([joined()], pa.string()))

        for batch in batches:
            if not len(batch):
                continue
            numbers, blocks, states, depths = _numbers(batch, "no", "block", "state_in", "depth_in")
            does, values = _numbers(batch, "e0", "e1", "d0", "d1"), batch.column("value").cast(pa.string())
            for start, end in _runs(numbers[1:] != numbers[:-1]):
                if numbers[start] != no:
                    if parts:
                        yield part_row(False)
                    no, walk, parts, own = int(numbers[start]), _Walk(int(states[start]), int(depths[start])), [], None
                    at = opened = int(blocks[start])
                first = np.flatnonzero(starts(*walk.on(*(d[start:end] for d in does))))
                here = values.slice(start, end - start)
                if not len(first):
                    parts.append(here)
                else:
                    if first[0]:
                        parts.append(here.slice(0, first[0]))
                    if parts:
                        yield part_row(own is not None)
                    if len(first) > 1:
                        inner = here.slice(first[0], first[-1] - first[0])
                        lists = pa.ListArray.from_arrays(pa.array(first - first[0], pa.int32()), inner)
                        yield rows(no, at + first[:-1], at + first[:-1], True, pc.binary_join(lists, separator))
                    own = opened = at + int(first[-1])
                    parts = [here.slice(first[-1])]
                at += end - start
        if parts:
            yield part_row(False)

    return run


def read_groups(spark: SparkSession, path: str | list[str], separator: str, step: Callable[[Column], Step],
                starts: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(source_file, row_ord, value): the pieces of files, those joined that belong together.

    ``starts(state, depth)`` says which pieces begin a group, by the states and depths before them; the first piece of a
    file must. ``row_ord`` ascends along a file. Groups are joined by the tasks that read their block, so no text is moved
    or stored but for the two parts that a block can have of groups across several. There is one row per block besides.
    """
    ship_package(spark)
    blocks = _blocks(spark, path, separator, step)
    rows = _scan(spark, path, separator, step).join(F.broadcast(blocks), ["source_file", "block"], "left")
    # Blocks that were cut elsewhere than at first must not go unseen.
    known = F.coalesce("no", F.raise_error(F.lit("the blocks of the files have changed while they were read")).cast("long"))
    grouped = rows.select(known.alias("no"), "block", "value", "e0", "e1", "d0", "d1", "state_in", "depth_in").mapInArrow(
        _groups(separator, starts), _GROUP)
    files = F.broadcast(blocks.select("no", "source_file", "block"))
    some = store(grouped.filter(~F.col("whole")).join(files, "no").select("source_file", "block", "at", "own", "value"), "parts")

    # A part without a start belongs to the last group that starts before its block.
    last = blocks.select("source_file", "block").join(some.groupBy("source_file", "block").agg(F.max("own").alias("last")), ["source_file", "block"], "left")
    carried = last.select("source_file", "block", F.last("last", ignorenulls=True).over(_before(["source_file"], "block")).alias("carried"))
    owned = some.join(carried, ["source_file", "block"]).withColumn("own", F.coalesce("own", "carried"))
    parts = F.array_sort(F.collect_list(F.struct("at", "value")))
    joined = owned.groupBy("source_file", F.col("own").alias("row_ord")).agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), separator).alias("value"))
    whole = grouped.filter("whole").join(files, "no").select("source_file", F.col("at").alias("row_ord"), "value")
    return whole.unionByName(joined)
