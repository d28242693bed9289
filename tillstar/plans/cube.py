"""A summary of the sales by month, category, size and day part that any slice can be asked of.

Sums add up; distinct counts do not. So the summary keeps bitmaps over dense order numbers and over
the days of a month: the distinct count of any union of its cells is the count of their bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.money import cents, from_cents, ratio
from tillstar.operators.ordered import ONE_TASK_ROWS, number_rows
from tillstar.plans.measures import MEASURES, RATIOS, SliceSpec
from tillstar.plans.star import Star, enriched, star_of
from tillstar.session import shared_dir

AXES = ["year_month", "item_category", "item_size", "day_part"]


#: Lines that one task puts to their orders.
TASK_LINES = 1_000_000


@dataclass(frozen=True)
class Cube:
    """``sums`` has a row for each cell, ``orders`` one for each cell and 32,768 order numbers.

    Orders are numbered by day, so a cell's orders lie close together and fill few bitmaps.
    """

    star: Star
    numbers: DataFrame
    sums: DataFrame
    orders: DataFrame


def _lines(star: Star, where: SliceSpec) -> DataFrame:
    """The lines of a slice that have an order."""
    return where.apply(enriched(star)).filter("order_id IS NOT NULL")


def _sums(lines: DataFrame) -> DataFrame:
    """Sums of lines by all axes."""
    return lines.select(
        *AXES, cents(F.col("total_price")).alias("cents"), F.col("quantity").alias("items"),
        F.expr("shiftleft(1, day_of_month - 1)").alias("day"),
    ).groupBy(*AXES).agg(
        F.sum("cents").alias("cents"), F.sum("items").alias("items"), F.bit_or("day").alias("days")
    )


def _bitmaps(numbered: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of ``place`` in ``bucket``."""
    return numbered.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def _placed(numbers: DataFrame, *columns: str) -> DataFrame:
    """``order_no`` as the number of its bitmap and its place there."""
    return numbers.select(
        *columns, F.bitmap_bucket_number("order_no").alias("bucket"),
        F.bitmap_bit_position("order_no").alias("place"),
    )


def _order_cells(star: Star, cells: DataFrame) -> DataFrame:
    """Every order with its first day and the numbers of its cells.

    Lines are dealt by their own id first, so many at a task, and are put together there before
    they go to their order: an order may have any part of all lines.
    """
    known = cells.select("cell", *[F.col(a).alias(f"{a}_of") for a in AXES])
    same = reduce(and_, [F.col(a).eqNullSafe(F.col(f"{a}_of")) for a in AXES])
    tasks = ceil(star.fact_order_items.count() / TASK_LINES) or 1
    lines = _lines(star, SliceSpec()).join(known, same).select(
        "order_item_id", "order_id", "date_key", "cell"
    )
    return lines.repartition(tasks, "order_item_id").groupBy("order_id").agg(
        F.min("date_key").alias("day"), F.collect_set("cell").alias("cells")
    )


def build_cube(
    star: Star, stage: Callable[[DataFrame, str, list[str]], DataFrame],
    one_task_rows: int = ONE_TASK_ROWS,
) -> Cube:
    """``stage(df, name, partition columns)`` writes a table and reads it back.

    Bitmaps are made of the orders as numbered, with no join, and dealt to tasks by whole bitmaps:
    a task has about ``one_task_rows`` orders, and a bitmap is made once and not in parts.
    """
    sums = stage(_sums(_lines(star, SliceSpec())), "sums", ["year_month"])
    cells = number_rows(sums.select(*AXES), AXES, "cell", limit=one_task_rows)
    cells = stage(cells.withColumn("cell", F.col("cell").cast("int")), "cells", [])
    by_order = stage(_order_cells(star, cells), "order_cells", [])
    count = by_order.count()
    numbers = number_rows(by_order, ["day", "order_id"], "order_no", count, one_task_rows)
    numbers = stage(numbers.select("order_id", "order_no", "cells"), "order_numbers", [])
    placed = _placed(numbers, "cells").repartition(ceil(count / one_task_rows) or 1, "bucket")
    bits = _bitmaps(placed.withColumn("cell", F.explode("cells")), ["cell"])
    orders = bits.join(cells, "cell").select(*AXES, "bucket", "bits")
    return Cube(
        star, numbers.select("order_id", "order_no"), sums, stage(orders, "orders", ["year_month"])
    )


_BUILT: dict[tuple[str, str, str], Cube] = {}


def cube_of(spark: SparkSession, sf_dir: str, source: str = "retail") -> Cube:
    """The summary of a set of test tables, built once per star in the shared folder."""
    star = star_of(spark, sf_dir, source)
    key = (spark.sparkContext.applicationId, str(sf_dir), source)
    if key not in _BUILT or _BUILT[key].star is not star:
        folder = f"{shared_dir(spark)}/cube-{source}-{uuid.uuid4().hex[:8]}"
        _BUILT[key] = build_cube(star, lambda df, name, by: partitioned(df, f"{folder}/{name}", by))
    return _BUILT[key]


def partitioned(df: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Write a table by partition columns, few files for each, and read it back."""
    df = df.hint("rebalance", *by) if by else df
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _months(where: SliceSpec) -> tuple[SliceSpec, list[SliceSpec]]:
    """The whole months of a slice, and what is left of it at either end.

    The first has no days any more; the others keep their days, at most one month each.
    """
    whole, edges = replace(where, date_from=None, date_to=None), []
    first = date.fromisoformat(where.date_from) if where.date_from else None
    last = date.fromisoformat(where.date_to) if where.date_to else None
    if first and last and first > last:
        return replace(whole, months=("none",)), []
    after = last + timedelta(days=1) if last else None
    start = first and (first.replace(day=1) if first.day == 1 else _next_month(first))
    end = after and after.replace(day=1)  # the month this day is in is not whole
    if start and end and start > end:  # both days are inside of one month
        return replace(whole, months=("none",)), [where]
    if first and first != start:
        edges.append(replace(where, date_to=str(start - timedelta(days=1))))
    if after and after != end:
        edges.append(replace(where, date_from=str(end)))
    whole = replace(whole, date_from=str(start) if start else None, date_to=str(end) if end else None)
    return whole, edges


def _next_month(day: date) -> date:
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1)


def _whole_months(cells: DataFrame, where: SliceSpec) -> DataFrame:
    """Cells of a slice from the start of one month to before another; months are read apart."""
    for name, wanted in zip(AXES, (where.months, where.categories, where.sizes, where.day_parts)):
        if wanted:
            cells = cells.filter(F.col(name).isin(*wanted))
    if where.date_from:
        cells = cells.filter(F.col("year_month") >= where.date_from[:7])
    if where.date_to:
        cells = cells.filter(F.col("year_month") < where.date_to[:7])
    return cells


def sliced(
    cube: Cube, where: SliceSpec = SliceSpec(), names: Iterable[str] = MEASURES,
    by: Iterable[str] = (),
) -> DataFrame:
    """The named measures of a slice, for each value of some of the axes.

    Whole months come from the summary alone. Where a slice starts or ends inside a month, the
    lines of those days, and of no others, are summed up as the summary was, and added.
    """
    names, by = list(names), list(by)
    if unknown := [n for n in names if n not in MEASURES] + [b for b in by if b not in AXES]:
        raise ValueError(f"unknown measures or axes: {unknown}")
    whole, edges = _months(where)
    sums, orders = _whole_months(cube.sums, whole), _whole_months(cube.orders, whole)
    for edge in edges:
        lines = _lines(cube.star, edge)
        sums = sums.unionByName(_sums(lines))
        placed = _placed(lines.join(cube.numbers, "order_id"), *AXES)
        orders = orders.unionByName(_bitmaps(placed, AXES))
    none = F.lit(None).cast("bigint")
    parts = [
        sums.select(*by, "cents", "items", none.alias("trading_days"), none.alias("orders")),
        sums.groupBy(*dict.fromkeys([*by, "year_month"])).agg(F.bit_or("days").alias("days")).select(
            *by, none.alias("cents"), none.alias("items"),
            F.bit_count("days").cast("bigint").alias("trading_days"), none.alias("orders"),
        ),
        orders.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).select(
            *by, none.alias("cents"), none.alias("items"), none.alias("trading_days"),
            F.bitmap_count("bits").alias("orders"),
        ),
    ]
    base = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(*by).agg(
        from_cents(F.sum("cents")).alias("revenue"), F.sum("items").alias("items_sold"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("trading_days", "orders")],
    )
    return base.select(*by, *[
        ratio(F.col(RATIOS[n][0]), F.col(RATIOS[n][1]), RATIOS[n][2]).alias(n) if n in RATIOS
        else F.col(n) for n in names
    ])
