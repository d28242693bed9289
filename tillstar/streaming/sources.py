"""File streams: the stream itself, the rows of one of its micro-batches, and running it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tillstar.session import brief_shuffles, shared_dir

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class Inbox:
    """A folder that Parquet files are delivered to.

    A stateful query only carries what its state needs. What else a micro-batch needs of its rows
    it reads by :meth:`batch`, from the files that Spark's own log names for that micro-batch; so
    both see the same rows, also when a micro-batch is done again.
    """

    spark: SparkSession
    folder: str
    schema: StructType
    files_per_batch: int | None = None

    def stream(self) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.parquet(self.folder)

    def batch(self, checkpoint: str, number: int) -> Batch:
        """A micro-batch of the query with that checkpoint, which has this one source."""
        known = _offsets(self.spark, checkpoint, number)
        watermark, last = known[number]
        before_watermark, before = known.get(number - 1, (watermark, -1))
        files = _logged_files(self.spark, checkpoint, before, last)
        reader = self.spark.read.schema(self.schema)
        rows = reader.parquet(*files) if files else self.spark.createDataFrame([], self.schema)
        return Batch(rows, before_watermark)


@dataclass(frozen=True)
class Batch:
    """Rows of a micro-batch, and the time (milliseconds) up to which windows were closed before it.

    That is the watermark which the micro-batch before it ran with: Spark closes windows by a
    micro-batch's own watermark, after it has taken in the rows of the micro-batch.
    """

    rows: DataFrame
    closed_until: int


def _offsets(spark: SparkSession, checkpoint: str, number: int) -> dict[int, tuple[int, int]]:
    """Watermark and last entry of the source's log, of a micro-batch and the one before it."""
    logs = f"{checkpoint}/offsets/{{{max(number - 1, 0)},{number}}}"
    out = {}
    for r in spark.read.text(logs, wholetext=True).select("_metadata.file_name", "value").collect():
        _, settings, offset = r.value.split("\n")[:3]
        entry = -1 if offset == "-" else json.loads(offset)["logOffset"]
        out[int(r.file_name)] = (json.loads(settings)["batchWatermarkMs"], entry)
    return out


def _logged_files(spark: SparkSession, checkpoint: str, after: int, last: int) -> list[str]:
    """Files of the entries behind ``after`` up to ``last``; every tenth entry sums up all before."""
    if after >= last:
        return []
    names = ",".join(f"{i},{i}.compact" for i in range(after + 1, last + 1))
    lines = spark.read.text(f"{checkpoint}/sources/0/{{{names}}}").collect()
    entries = [json.loads(r.value) for r in lines if r.value.startswith("{")]
    return sorted({e["path"] for e in entries if after < e["batchId"] <= last})


def in_turn(parts: list[DataFrame], folder: str, take: Callable[[Inbox], None]) -> None:
    """Deliver one of ``parts`` after the other, with as many files each as it has partitions.

    ``take`` runs a stream over what is there after each delivery.
    """
    for part in parts:
        part.write.mode("append").parquet(folder)
        take(Inbox(part.sparkSession, folder, part.schema))


def deliver(part: DataFrame, folder: str, files: int, mode: str = "append") -> None:
    """Write ``part`` as exactly ``files`` files, without a shuffle; some may have no rows."""
    spark = part.sparkSession
    part = part.coalesce(files)
    with brief_shuffles(spark):
        part.write.mode(mode).option("compression", "zstd").parquet(folder)
    added = spark.read.schema(part.schema).parquet(folder)
    for _ in range(-len(added.inputFiles()) % files):
        spark.createDataFrame([], part.schema).write.mode("append").parquet(folder)


def one_batch_each(parts: list[DataFrame], folder: str, files: int | None = 4) -> Inbox:
    """Deliver ``parts`` as ``files`` files each, to be taken one part for each micro-batch.

    A file stream goes by file times, so parts are written one after the other. A part needs as
    many rows as files, for none of them to be left out. Without ``files`` parts are written as they
    are partitioned, and those that make fewer files than another get some without rows.
    """
    spark, schema = parts[0].sparkSession, parts[0].schema
    if files is None:
        files = max(part.rdd.getNumPartitions() for part in parts) or 1
        for part in parts:
            deliver(part, folder, files)
    else:
        for part in parts:
            part.repartition(files).write.mode("append").parquet(folder)
    if len(spark.read.schema(schema).parquet(folder).inputFiles()) != files * len(parts):
        raise ValueError(f"a part has fewer than {files} rows")
    return Inbox(spark, folder, schema, files_per_batch=files)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


@contextmanager
def _kept_in_rocksdb(spark: SparkSession):
    """State in RocksDB on the executors' disks, with its changes logged in the checkpoint."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what is there and stop; a later run goes on from the same checkpoint."""
    with _kept_in_rocksdb(spark):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
