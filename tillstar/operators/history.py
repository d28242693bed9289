"""Versioned dimension rows (slowly changing, type 2), rebuilt or kept up to date."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.session import shared_dir
from tillstar.sources.warehouse import staged

#: A bucket of so many folders is put together in the next one.
MERGED_FOLDERS = 16


def versions(
    observed: DataFrame, key: str, day: str, tracked: list[str], order: str
) -> DataFrame:
    """One row per key and period without a change of the ``tracked`` columns.

    ``version`` counts from 1, ``valid_from`` and ``valid_to`` are days (the current version has no
    end). Observations are first reduced to the last ones per key and day, so the windows see at
    most one row per calendar day of a key, however often it was sold.
    """
    last = _last_of_days(observed, key, day, tracked, order)
    timeline = Window.partitionBy(key).orderBy(day)
    starts = last.withColumn("_new", _changed(timeline, tracked)).filter("_new")
    return _with_ends(starts, key, day, tracked, F.row_number().over(timeline))


def _last_of_days(
    observed: DataFrame, key: str, day: str, tracked: list[str], order: str
) -> DataFrame:
    last = observed.groupBy(key, day).agg(F.max_by(F.struct(*tracked), order).alias("_last"))
    return last.select(key, day, *[F.col(f"_last.{c}").alias(c) for c in tracked])


def _changed(timeline, tracked: list[str]) -> Column:
    first = F.row_number().over(timeline) == 1
    return reduce(or_, [~F.col(c).eqNullSafe(F.lag(c).over(timeline)) for c in tracked], first)


def _with_ends(
    starts: DataFrame, key: str, day: str, tracked: list[str], version: Column, *more: Column
) -> DataFrame:
    following = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    return starts.select(
        key,
        version.alias("version"),
        *tracked,
        F.col(day).alias("valid_from"),
        F.date_sub(following, 1).alias("valid_to"),
        following.isNull().alias("is_current"),
        *more,
    )


@dataclass(frozen=True)
class VersionTable:
    """Versions in a folder, dealt to buckets by key and changed bucket by bucket.

    Each change writes, of the buckets that get a new version, the current versions and those that
    ended with it to a folder of its own, and then one manifest, which names the folders of every
    bucket; buckets without a change keep their files. In a bucket's older folders the ended versions
    stay good, which are not written again until the folders are many, and current ones are out of date.
    Readers go by the newest manifest, so they see a change as a whole or not at all.
    """

    spark: SparkSession
    root: str
    key: str
    tracked: list[str]
    buckets: int = 16

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _manifest(self) -> tuple[int, dict[int, list[str]], object]:
        """Number of the last change, folders of each bucket, and the last day observed."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        numbers = [
            int(s.getPath().getName()) for s in (fs.listStatus(path) if fs.exists(path) else [])
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        ]
        if not numbers:
            return 0, {}, None
        rows = self.spark.read.parquet(f"{self.root}/manifest/{max(numbers)}").collect()
        return max(numbers), {r.bucket: r.folders for r in rows if r.folders}, rows[0].last_day

    def _newest(self, folders: dict[int, list[str]]) -> DataFrame | None:
        """The newest folder of each bucket: it has all current versions."""
        if not folders:
            return None
        return self.spark.read.parquet(
            *[f"{runs[-1]}/bucket={bucket}" for bucket, runs in sorted(folders.items())]
        )

    def _read(self, folders: dict[int, list[str]]) -> DataFrame | None:
        newest = self._newest(folders)
        older = [f"{run}/bucket={bucket}" for bucket, runs in sorted(folders.items()) for run in runs[:-1]]
        if not older:
            return newest
        return newest.unionByName(self.spark.read.parquet(*older).filter("NOT is_current"))

    def read(self) -> DataFrame | None:
        """All versions; None before the first change."""
        return self._read(self._manifest()[1])

    def apply(self, observed: DataFrame, day: str, order: str) -> list[int]:
        """Merge what was observed on days after all earlier ones; returns the buckets rewritten.

        A key's current version is its first observation, so the result is that of a rebuild. Only
        keys that differ from it get versions, and only their buckets are written.
        Days up to the last one observed are an error: between two observations of a version there
        is nothing to tell where a late one belongs. Without observations nothing changes.
        """
        number, folders, last_day = self._manifest()
        last = _last_of_days(observed, self.key, day, self.tracked, order)
        scratch = f"{shared_dir(self.spark)}/versions-{uuid.uuid4().hex[:8]}"
        last = staged(last.withColumn("bucket", self._bucket()), scratch, "last")
        seen = last.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
        if seen.first is None:
            return []
        if last_day is not None and seen.first <= last_day:
            raise ValueError(f"{seen.first} comes after {last_day} has been observed")
        met = [r.bucket for r in last.select("bucket").distinct().collect()]  # as many as buckets
        known = self._newest({b: folders[b] for b in met if b in folders})
        timeline = Window.partitionBy(self.key).orderBy(day)
        rows = last.select(self.key, day, *self.tracked, F.lit(None).cast("int").alias("_version"))
        if known is not None:
            current = known.filter("is_current").select(
                self.key, F.col("valid_from").alias(day), *self.tracked,
                F.col("version").alias("_version"),
            )
            rows = rows.unionByName(current)
        starts = rows.withColumn("_new", _changed(timeline, self.tracked)).filter("_new")
        before = F.coalesce(F.max("_version").over(Window.partitionBy(self.key)), F.lit(1))
        ended = staged(
            _with_ends(
                starts, self.key, day, self.tracked,
                (before + F.row_number().over(timeline) - 1).cast("int"),
                F.col("_version").isNull().alias("_fresh"), self._bucket().alias("bucket"),
            ),
            scratch, "ended",
        )
        changed = sorted(
            r.bucket for r in ended.filter("_fresh").select("bucket").distinct().collect()
        )
        run = f"{self.root}/runs/{number + 1}-{uuid.uuid4().hex[:8]}"
        many = {b: folders[b] for b in changed if len(folders.get(b, [])) >= MERGED_FOLDERS}
        if changed:
            out = ended.filter(F.col("bucket").isin(*changed)).drop("_fresh", "bucket")
            if many:
                out = out.unionByName(self._read(many).filter("NOT is_current"))
            out.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.partitionBy(
                "bucket"
            ).parquet(run)
        folders = folders | {b: [*([] if b in many else folders.get(b, [])), run] for b in changed}
        self.spark.createDataFrame(
            [(b, folders.get(b), seen.last) for b in range(self.buckets)],
            "bucket int, folders array<string>, last_day date",
        ).coalesce(1).write.parquet(f"{self.root}/manifest/{number + 1}")
        return changed
