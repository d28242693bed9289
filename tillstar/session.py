"""Session settings and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}

#: Spark removes the shuffle files of a query as it ends, not when the driver happens to collect garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. A cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillstar")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLSTAR_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application inside ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a local master gets a fresh
    temporary folder; a cluster must name a folder that every executor can reach.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = sc.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tillstar-")
        base = _LOCAL_DIRS[app]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tillstar-{sc.applicationId}"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in here go as soon as the written copy is there.

    Only for frames that are written once and read from the copy: a frame that is run again would
    have to shuffle again.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    with brief_shuffles(df.sparkSession):
        return df.select("*").checkpoint()
