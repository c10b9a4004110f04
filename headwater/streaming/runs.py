"""A log of mergeable rows per application, in runs of triggers that are merged level by level.

Each trigger writes one run, a folder named by the triggers it covers, with a folder for each bucket of application
ids. Once ``fan`` runs of one size lie side by side, they are merged into one, so there are at most ``fan`` runs for each power of ``fan``,
however many triggers there were, and each row is rewritten once a level. A reader
takes the complete runs that no other covers, so a merge that is cut off counts nothing twice; the merged runs are deleted when
the next merge is done, so readers that have planned with them have time to end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.session import children, delete_path, path_exists

BUCKETS = 32


class Run(NamedTuple):
    """The triggers that a folder covers."""

    first: int
    last: int

    @property
    def folder(self) -> str:
        return f"run={self.first}-{self.last}"

    @property
    def size(self) -> int:
        return self.last - self.first + 1

    def covers(self, other: Run) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


def bucket(app_id: Column | str = "app_id") -> Column:
    return F.pmod(F.xxhash64(app_id), F.lit(BUCKETS)).cast("int")


def buckets_of(apps: DataFrame) -> list[int]:
    """The buckets that some applications lie in: at most BUCKETS numbers."""
    return sorted(row.bucket for row in apps.select(bucket().alias("bucket")).distinct().collect())


class RunLog:
    """The runs below a folder; ``schema`` is that of the rows, which have an ``app_id``."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def _write(self, rows: DataFrame, run: Run) -> None:
        # the rebalance gathers a bucket's rows into few files, and splits a large bucket
        placed = rows.withColumn("bucket", bucket()).hint("rebalance", "bucket")
        placed.write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/{run.folder}")

    def write(self, rows: DataFrame, number: int) -> None:
        """Store the rows of a trigger; the same trigger again replaces them."""
        self._write(rows, Run(number, number))

    def every_run(self) -> list[Run]:
        """The complete runs, those that others cover included."""
        found = [re.fullmatch(r"run=(-?\d+)-(-?\d+)", child.name) for child in children(self.spark, self.path)]
        named = sorted(Run(int(m[1]), int(m[2])) for m in found if m)
        return [run for run in named if path_exists(self.spark, f"{self.path}/{run.folder}/_SUCCESS")]

    def runs(self, upto: int | None = None) -> list[Run]:
        """The runs that make up the log, or what it was after the trigger ``upto``."""
        every = self.every_run()
        if upto is not None:
            # merged runs that are not deleted yet may still tell
            every = [run for run in every if run.last <= upto or run.first > upto or not self._pieces(every, run, upto)]
            every = [run for run in every if run.first <= upto]
            late = [run for run in every if run.last > upto]
            if late:
                raise LookupError(f"triggers {late[0].first} to {late[0].last} are merged: the state after {upto} is not kept")
        return [run for run in every if not any(other.covers(run) for other in every)]

    @staticmethod
    def _pieces(every: list[Run], whole: Run, upto: int) -> bool:
        """Whether other runs hold all triggers of ``whole`` up to ``upto``."""
        at = whole.first
        for run in every:
            if run != whole and run.first == at and run.last <= upto:
                at = run.last + 1
        return at > upto

    def read(self, upto: int | None = None, buckets: Sequence[int] | None = None, runs: Sequence[Run] | None = None) -> DataFrame:
        """The rows of the runs up to ``upto``; only the given buckets are opened."""
        chosen = self.runs(upto) if runs is None else runs
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{run.folder}" for run in chosen]
        found = self.spark.read.schema(f"{self.schema}, bucket int").option("basePath", self.path).parquet(*paths)
        if buckets is not None:
            found = found.where(F.col("bucket").isin(list(buckets)))
        return found.drop("bucket", "run")

    def merge_all(self, merge: Callable[[DataFrame], DataFrame], upto: int | None = None) -> Run | None:
        """Merge all runs up to ``upto`` into one."""
        return self._merge([run for run in self.runs() if upto is None or run.last <= upto], merge)

    def _merge(self, runs: Sequence[Run], merge: Callable[[DataFrame], DataFrame]) -> Run | None:
        if len(runs) < 2:
            return None
        for old in self._covered():
            delete_path(self.spark, f"{self.path}/{old.folder}")
        whole = Run(runs[0].first, runs[-1].last)
        self._write(merge(self.read(runs=runs)), whole)
        return whole

    def _covered(self) -> list[Run]:
        every = self.every_run()
        return [run for run in every if any(other.covers(run) for other in every)]

    def compact(self, fan: int, merge: Callable[[DataFrame], DataFrame], upto: int) -> list[Run]:
        """Merge the runs of each size, small ones first, of which ``fan`` lie side by side; returns the new runs.

        ``upto`` is one trigger behind the newest, so that this one may be repeated.
        """
        made, fan, size = [], max(fan, 2), 1
        while True:
            runs = [run for run in self.runs() if run.last <= upto]
            if not any(run.size >= size for run in runs):
                return made
            level = [run for run in runs if size <= run.size < size * fan]
            if len(level) >= fan:
                # all from the first of this size on: what comes later is smaller
                made.append(self._merge(runs[runs.index(level[0]) :], merge))
            size *= fan
