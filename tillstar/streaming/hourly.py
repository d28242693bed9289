"""Demand per hour of event time over a stream: closed hours, late lines, open hours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.money import cents, from_cents
from tillstar.streaming.runs import FAN_IN, Runs
from tillstar.streaming.sources import Inbox, run_available

CLOSED, LATE, UNTIMED = "closed", "late", "untimed"

PARTIAL = "hour_start timestamp_ntz, kind string, lines bigint, cents bigint"

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _instant(local: str) -> Column:
    """A local time as an instant that has it in UTC, whatever the session's time zone."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH}, {local}))")


def _local(instant: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({instant}), {_EPOCH})")


def _sums(lines: DataFrame, *by: str | Column) -> DataFrame:
    return lines.groupBy(*by).agg(
        F.count("*").alias("lines"), F.sum(cents(F.col("total_price"))).alias("cents")
    )


def merged(parts: DataFrame) -> DataFrame:
    """Partial sums of the same hour and kind added up."""
    return parts.groupBy("hour_start", "kind").agg(
        F.sum("lines").alias("lines"), F.sum("cents").alias("cents")
    )


def _runs(spark: SparkSession, target: str, fan_in: int = FAN_IN) -> Runs:
    return Runs(spark, f"{target}/sums", PARTIAL, merged, fan_in)


def closed_hours(lines: DataFrame, delay: str) -> DataFrame:
    """Sums of each hour of ``order_ts``, once the stream is ``delay`` past its end."""
    timed = lines.select("total_price", _instant("order_ts").alias("at"))
    hours = _sums(timed.withWatermark("at", delay), F.window("at", "1 hour").alias("hour"))
    return hours.select(_local("hour.start").alias("hour_start"), "lines", "cents")


def run_hourly(
    inbox: Inbox, prepare: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
    delay: str = "1 hour", fan_in: int = FAN_IN,
) -> None:
    """Sum the lines that ``prepare`` makes of an inbox by hour of ``order_ts``.

    An hour leaves the state store once, when the latest time seen is ``delay`` past its end. Lines
    of an hour that has left would be dropped by the window; each micro-batch sums them by itself,
    as it does lines without a time, so none is lost. All sums of a micro-batch are one run, and
    runs are merged in levels: the number of folders grows with the logarithm of the micro-batches.
    """
    spark = inbox.spark

    def each(closed: DataFrame, number: int) -> None:
        batch = inbox.batch(checkpoint, number)
        lines = prepare(batch.rows)
        hour = F.date_trunc("hour", "order_ts").cast("timestamp_ntz")
        ends = F.unix_millis(_instant("hour_start")) + 3_600_000
        late = ends <= batch.closed_until
        kind = F.when(F.col("hour_start").isNull(), UNTIMED).when(late, LATE)
        other = lines.select("total_price", hour.alias("hour_start")).withColumn("kind", kind)
        missed = _sums(other.filter("kind IS NOT NULL"), "hour_start", "kind")
        _runs(spark, target, fan_in).add(
            closed.withColumn("kind", F.lit(CLOSED)).select("hour_start", "kind", "lines", "cents")
            .unionByName(missed.select("hour_start", "kind", "lines", "cents")),
            number,
        )

    hours = closed_hours(prepare(inbox.stream()), delay)
    run_available(spark, hours.writeStream.foreachBatch(each), checkpoint)


def open_hours(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Sums of the hours that are still in the state store after the last micro-batch."""
    state = spark.read.format("statestore").load(checkpoint).select("key.*", "value.*")
    return state.toDF("hour", "lines", "cents").select(
        _local("hour.start").alias("hour_start"), "lines", "cents"
    )


def hourly_result(
    spark: SparkSession, target: str, checkpoint: str, include_open: bool = True
) -> DataFrame:
    """All hours so far with their late lines; hours still open are included unless asked not to."""
    runs = _runs(spark, target).read()
    parts = [] if runs is None else [runs.select("hour_start", "lines", "cents")]
    if include_open:
        parts.append(open_hours(spark, checkpoint))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy("hour_start").agg(
        F.sum("lines").alias("lines"), from_cents(F.sum("cents")).alias("revenue")
    )


def arrivals(spark: SparkSession, target: str) -> DataFrame:
    """Lines by the way they came in: closed with their hour, late for it, or without a time."""
    runs = _runs(spark, target).read()
    return runs.groupBy("kind").agg(F.sum("lines").alias("lines"))
