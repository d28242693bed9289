"""Partial results of micro-batches in levels that are merged as they fill up."""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import DataFrame, SparkSession

FAN_IN = 8


class Runs:
    """Folders ``level.first-last``, each the merged partial results of a range of micro-batches.

    ``fan_in`` runs of a level make one of the next, so there are fewer than ``fan_in`` for each of
    logarithmically many levels. A run counts once it is written whole and as long as no larger
    whole run holds its range, so a merge that breaks off changes nothing; a micro-batch that is
    done again overwrites its own run, or leaves the larger one that has taken it in.
    """

    def __init__(
        self, spark: SparkSession, folder: str, schema: str,
        merge: Callable[[DataFrame], DataFrame], fan_in: int = FAN_IN,
    ):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.merge, self.fan_in = merge, fan_in
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def live(self) -> list[tuple[int, int, int]]:
        """(level, first, last) of the runs that count, by range."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        whole = []
        for status in self._fs.listStatus(self._path(self.folder)):
            name = status.getPath().getName()
            if self._fs.exists(self._path(f"{self.folder}/{name}/_SUCCESS")):
                level, span = name.split(".")
                whole.append((int(level), *map(int, span.split("-"))))
        held = [
            r for r in whole
            if not any(o[0] > r[0] and o[1] <= r[1] and r[2] <= o[2] for o in whole)
        ]
        return sorted(held, key=lambda r: r[1])

    def _at(self, run: tuple[int, int, int]) -> str:
        return f"{self.folder}/{run[0]}.{run[1]}-{run[2]}"

    def _read(self, runs: list[tuple[int, int, int]]) -> DataFrame:
        return self.merge(self.spark.read.schema(self.schema).parquet(*map(self._at, runs)))

    def read(self) -> DataFrame | None:
        """All partial results so far, merged; None before the first."""
        runs = self.live()
        return self._read(runs) if runs else None

    def add(self, partial: DataFrame, number: int) -> None:
        if any(level and first <= number <= last for level, first, last in self.live()):
            return
        partial.write.mode("overwrite").parquet(self._at((0, number, number)))
        level = 0
        while len(full := [r for r in self.live() if r[0] == level]) >= self.fan_in:
            merged = (level + 1, full[0][1], full[-1][2])
            self._read(full).write.mode("overwrite").parquet(self._at(merged))
            for run in full:
                self._fs.delete(self._path(self._at(run)), True)
            level += 1
