"""Row numbers, ranks and running totals over a whole frame without sending it to one task.

A window without a partition clause sorts everything in one task. Up to ``ONE_TASK_ROWS`` rows
(the row count is checked) that is the quickest way. Beyond it the frame is cut into contiguous ranges of the
sort order, each range is numbered by itself, and the few per-range totals shift the results.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import checkpointed

ONE_TASK_ROWS = 200_000


def _in_ranges(df: DataFrame, order: list[Column], rows: int, limit: int) -> DataFrame:
    if rows <= limit:
        return df.withColumn("_range", F.lit(0))
    parts = max(2, ceil(rows / limit))
    ranged = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    # Partition numbers are only a fact once they are written down.
    return checkpointed(ranged)


def _with_offsets(ranged: DataFrame, totals: dict[str, Column], single: bool) -> DataFrame:
    """Add, per range, the totals of all ranges before it (one row per range, so tiny)."""
    if single:
        return ranged.withColumns({n: F.lit(0) for n in totals})
    per_range = ranged.groupBy("_range").agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "_range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals]
    )
    return ranged.join(F.broadcast(offsets), "_range")


def number_rows(
    df: DataFrame, order: list[str], out: str, rows: int | None = None, limit: int = ONE_TASK_ROWS
) -> DataFrame:
    """Dense numbers 1..n in the given sort order, for surrogate keys."""
    rows = df.count() if rows is None else rows
    ranged = _in_ranges(df, [F.col(c) for c in order], rows, limit)
    shifted = _with_offsets(ranged, {"_before": F.count("*")}, rows <= limit)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return shifted.withColumn(out, (place + F.col("_before")).cast("bigint")).drop(
        "_range", "_before"
    )


def rank_from_top(
    df: DataFrame,
    value: str,
    tie: list[str],
    rows: int,
    *,
    rank: str | None = None,
    dense_rank: str | None = None,
    position: str | None = None,
    running: dict[str, str] | None = None,
    running_with_ties: str | None = None,
    limit: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Ranks and running totals from the highest ``value`` down.

    ``rows`` is an upper bound of the row count. ``running`` maps output name to summed column,
    row by row in (value, tie) order; ``running_with_ties`` sums ``value`` up to and including all
    rows of equal value.

    What equal values share is worked out on distinct values with their counts and sums, and joined
    back. What tells rows apart is cut into ranges of (value, tie). So rows of equal value may be
    any part of all without meeting in one task.
    """
    out = df
    running = running or {}
    down = F.col(value).desc()
    if position or running:
        ranged = _in_ranges(out, [down, *[F.col(c) for c in tie]], rows, limit)
        totals = {"_rows": F.count("*")}
        totals |= {f"_sum_{n}": F.sum(c) for n, c in running.items()}
        shifted = _with_offsets(ranged, totals, rows <= limit)
        each = Window.partitionBy("_range").orderBy(down, *tie)
        so_far = each.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new: dict[str, Column] = {}
        if position:
            new[position] = (F.row_number().over(each) + F.col("_rows")).cast("bigint")
        for name, summed in running.items():
            new[name] = F.sum(summed).over(so_far) + F.col(f"_sum_{name}")
        out = shifted.withColumns(new).drop("_range", *totals)
    if rank or dense_rank or running_with_ties:
        sum_type = df.select(F.sum(value).alias("s")).schema["s"].dataType
        values = df.groupBy(F.col(value).alias("_value")).agg(
            F.count("*").alias("_n"), F.sum(value).alias("_sum")
        )
        top = F.col("_value").desc()
        ranged = _in_ranges(values, [top], rows, limit)
        totals = {"_rows": F.sum("_n"), "_total": F.sum("_sum"), "_values": F.count("*")}
        shifted = _with_offsets(ranged, totals, rows <= limit)
        place = Window.partitionBy("_range").orderBy(top)
        to_here = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new = {}
        if rank:
            above = F.sum("_n").over(to_here) - F.col("_n") + F.col("_rows")
            new[rank] = (above + 1).cast("bigint")
        if dense_rank:
            new[dense_rank] = (F.row_number().over(place) + F.col("_values")).cast("bigint")
        if running_with_ties:
            total = F.sum("_sum").over(to_here) + F.col("_total")
            new[running_with_ties] = total.cast(sum_type)
        ranked = shifted.withColumns(new).select("_value", *new)
        out = out.join(ranked, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
    return out


def weighted_quantiles(
    counts: DataFrame, value: str, weight: str, fractions: list[float], rows: int,
    limit: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Linearly interpolated quantiles of values with counts, as one row of doubles q0, q1, ...

    ``counts`` holds each value once; ``rows`` is an upper bound of their number. The row numbers
    of the wanted positions follow from running counts over ranges of values.
    """
    ranged = _in_ranges(counts, [F.col(value)], rows, limit)
    shifted = _with_offsets(ranged, {"_before": F.sum(weight)}, rows <= limit)
    to_here = Window.partitionBy("_range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = shifted.withColumn("_end", F.col("_before") + F.sum(weight).over(to_here))
    size = counts.agg(F.sum(weight)).scalar()
    picks = []
    for i, fraction in enumerate(fractions):
        place = F.lit(fraction) * (size - 1)
        for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("_end") - F.col(weight) <= index) & (index < F.col("_end"))
            picks.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"{side}{i}"))
        picks.append(F.max(place - F.floor(place)).alias(f"part{i}"))
    found = placed.agg(*picks)
    return found.select(
        *[
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(f"q{i}")
            for i in range(len(fractions))
        ]
    )


def exact_quantiles(
    df: DataFrame, value: str, fractions: list[float], limit: int = ONE_TASK_ROWS
) -> DataFrame:
    """Exact quantiles of a numeric column, reduced to its distinct values first."""
    counts = checkpointed(
        df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    )
    return weighted_quantiles(counts, value, "_n", fractions, counts.count(), limit)
