"""Groups of any size: no key, however frequent, has to be one task's work.

What a group's rows need to know of their group is a pre-combined aggregate that is joined back.
Spark splits the keys of such a join that are too frequent; a window could not be split.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(keys: list[str], left: DataFrame, right: DataFrame, suffix: str) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[k + suffix]) for k in keys])


def keep_first(
    df: DataFrame, keys: list[str], order: list[str], ties: bool = False
) -> DataFrame:
    """The first row of every key group, with ``ties`` all rows that are equal to it in ``order``.

    The ``= 1`` filter sits right on the row number, so each map task already drops all but its
    own first row per key and a group of copies shrinks before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    place = F.rank() if ties else F.row_number()
    return df.withColumn("_n", place.over(window)).filter(F.col("_n") == 1).drop("_n")


def with_totals(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Put group totals on every row of the group; null keys are a group too."""
    sums = df.groupBy(*[F.col(k).alias(f"{k}_of") for k in keys]).agg(
        *[c.alias(n) for n, c in totals.items()]
    )
    return df.join(sums, _same(keys, df, sums, "_of"), "left").select(
        *[df[c] for c in df.columns], *totals
    )


def mark_repeats(
    df: DataFrame, keys: list[str], order: str, live: Column, out: str
) -> DataFrame:
    """Flag every live row that is not the first of its key group.

    ``order`` must be unique per row. Rows that are not live are never flagged and never count.
    """
    base = df.withColumn("_live", live)
    first = base.filter("_live").groupBy(*[F.col(k).alias(f"{k}_of") for k in keys]).agg(
        F.min(order).alias("_first")
    )
    marked = base.join(first, base["_live"] & _same(keys, base, first, "_of"), "left")
    repeat = F.coalesce(F.col(order) != F.col("_first"), F.lit(False))
    return marked.withColumn(out, repeat).select(*df.columns, out)


def with_keys_of(df: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is among those of another table; a null matches a null."""
    wanted = keys_of.select(*[F.col(k).alias(f"{k}_of") for k in keys])
    return df.join(wanted, _same(keys, df, wanted, "_of"), "left_semi")
