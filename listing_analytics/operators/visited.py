"""Visited pages in levelled runs, so that testing candidates shuffles the candidates only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.session import discard, scratch_path


class VisitedRuns:
    """Runs of keys, each a table hashed into buckets and sorted by key.

    A run joins candidates that are hashed the same way without a shuffle or sort of its own. When a level has ``fanout``
    runs they become one run of the next level: a key is rewritten once per level, and candidates meet a number of runs
    that grows with the logarithm of the number of additions. Use as a context manager: the tables go at the end, also
    after an error.
    """

    def __init__(self, spark: SparkSession, key: str = "url_hash", fanout: int = 8):
        self.spark, self.key, self.fanout = spark, key, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []
        self.made: set[tuple[str, str]] = set()

    def __enter__(self) -> VisitedRuns:
        return self

    def __exit__(self, *_) -> None:
        for run in list(self.made):
            self._drop(run)

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"drop table if exists {run[0]}")
        discard(self.spark, run[1])
        self.made.discard(run)

    def hashed(self, rows: DataFrame, *by: str, name: str = "run") -> tuple[str, str]:
        """Write ``rows`` as a table in buckets of ``by``, sorted; it goes with the runs."""
        run = f"{name}_{uuid.uuid4().hex}", scratch_path(self.spark, name)
        self.made.add(run)
        rows.write.bucketBy(self.buckets, *by).sortBy(*by).option("path", run[1]).saveAsTable(run[0])
        return run

    def add(self, rows: DataFrame, dealt: bool = False) -> DataFrame:
        """File ``rows``, whose keys are new to the runs, and return them as stored. ``dealt``: already hashed by key."""
        newest = self.hashed(rows if dealt else rows.repartition(self.buckets, self.key), self.key)
        stored, level = self.spark.table(newest[0]), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(newest)
            if len(self.levels[level]) < self.fanout:
                return stored
            merged = None
            for name, _ in self.levels[level]:
                keys = self.spark.table(name).select(self.key)
                merged = keys if merged is None else merged.unionAll(keys)
            old, newest = self.levels[level], self.hashed(merged.repartition(self.buckets, self.key), self.key)
            self.levels[level] = []
            for run in old:
                if level:  # runs of the lowest level hold columns that the caller reads once more
                    self._drop(run)
            level += 1

    def release(self) -> None:
        """Delete the tables that have been merged into others."""
        live = {run for level in self.levels for run in level}
        for run in [r for r in self.made if r not in live and r[0].startswith("run_")]:
            self._drop(run)

    def missing(self, candidates: DataFrame, combined: str | None = None) -> DataFrame:
        """The rows of ``candidates`` whose key is in no run.

        ``combined`` names a column that an aggregation by the key has made and that is never null: asking for it keeps
        the test behind that aggregation, so that candidates are combined per task before they are shuffled.
        """
        for level in self.levels:
            for name, _ in level:
                run = self.spark.table(name).select(F.col(self.key).alias("_visited")).hint("merge")
                same = F.col(self.key) == F.col("_visited")
                candidates = candidates.join(run, same & F.col(combined).isNotNull() if combined else same, "left_anti")
        return candidates
