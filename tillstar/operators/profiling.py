"""Profile of raw text lines before anything is changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.calendar import is_strict_time, strict_date
from tillstar.functions.money import amount, cents, percent, ratio
from tillstar.operators import selection
from tillstar.operators.quarantine import price
from tillstar.schemas import RAW_COLUMNS
from tillstar.session import checkpointed

FD_COLUMNS = ["item_name", "item_category", "item_size", "unit_price"]


def tallies(
    raw: DataFrame, distinct: dict[str, list[str]], breaks: dict[str, Column] | None = None
) -> DataFrame:
    """One row: ``rows``, distinct values of each set of columns, and rows that a condition holds for.

    Every row gives a cell for each count: its number and the 128-bit digest of the values, nulls
    told apart from all else. Equal cells meet in one shuffle, after they have been added up on
    the map side, so the input is read once however many counts there are, and no value is one
    task's work.
    """
    breaks = breaks or {}

    def digest(columns: list[str]) -> tuple[Column, Column]:
        parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
        return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)

    cells = [digest(columns) for columns in distinct.values()]
    cells += [(F.coalesce(c, F.lit(False)).cast("bigint"), F.lit(0).cast("bigint")) for c in breaks.values()]
    tagged = F.array(*[
        F.struct(F.lit(i).alias("tag"), a.alias("a"), b.alias("b")) for i, (a, b) in enumerate(cells)
    ])
    met = raw.select(F.inline(tagged)).groupBy("tag", "a", "b").agg(F.count("*").alias("n"))
    tag, n = F.col("tag"), F.col("n")
    held = {
        name: F.coalesce(F.sum(F.when((tag == i) & (F.col("a") == 1), n)), F.lit(0))
        for i, name in enumerate(breaks, len(distinct))
    }
    return met.agg(
        F.coalesce(F.sum(F.when(tag == 0, n)), F.lit(0)).alias("rows"),
        *[F.count_if(tag == i).alias(name) for i, name in enumerate(distinct)],
        *[c.alias(name) for name, c in held.items()],
    )


def volume(raw: DataFrame) -> DataFrame:
    found = tallies(
        raw, {"distinct_item_id": ["item_id"], "distinct_order_id": ["order_id"]}
    )
    return found.select(
        "rows", F.lit(len(RAW_COLUMNS)).alias("columns"), "distinct_item_id", "distinct_order_id",
        (F.col("distinct_item_id") == F.col("rows")).alias("item_id_is_key"),
    )


def completeness(raw: DataFrame) -> DataFrame:
    """Blanks per column, all columns in one pass."""
    blank = {c: F.count_if(F.col(c).isNull() | (F.col(c) == "")) for c in RAW_COLUMNS}
    sums = raw.agg(F.count("*").alias("rows"), *[n.alias(f"b_{c}") for c, n in blank.items()])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"b_{c}").alias("blanks")) for c in blank]
    return sums.select("rows", F.inline(F.array(*cells))).select(
        "column", "blanks", percent(F.col("blanks"), F.col("rows")).alias("blank_pct")
    )


def duplicates(raw: DataFrame) -> DataFrame:
    found = tallies(raw, {"lines": RAW_COLUMNS, "ids": ["item_id"]})
    return found.select(
        (F.col("rows") - F.col("lines")).alias("duplicate_rows"),
        (F.col("rows") - F.col("ids")).alias("duplicate_item_id"),
    )


def domains(raw: DataFrame, columns: tuple[str, ...] = ("item_size", "item_category")) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    rows = raw.agg(F.count("*").alias("n")).scalar()
    return (
        raw.select(F.inline(F.array(*cells)))
        .groupBy("column", "value")
        .agg(F.count("*").alias("rows"))
        .withColumn("pct", percent(F.col("rows"), rows))
    )


def _number(column: str) -> Column:
    return price(F.col(column), "decimal(18,2)")


def _numbers(raw: DataFrame) -> DataFrame:
    return raw.select(*[_number(c).alias(c) for c in MEASURES])


MEASURES = ("quantity", "unit_price", "total_price")
QUARTILES = [0.25, 0.5, 0.75]
_LIMB = 10**9


def _limbs(whole: Column) -> tuple[Column, Column]:
    """A whole number, not negative, as ``high * 10 ** 9 + low``; sums of their products are exact."""
    low = F.pmod(whole, F.lit(_LIMB))
    return ((whole - low) / _LIMB).cast("decimal(19,0)"), low.cast("decimal(19,0)")


def moments(counts: DataFrame) -> DataFrame:
    """Count, sum of cents and sample deviation of each measure, from distinct values with counts.

    Deviations are taken from the whole part of the mean, so what is left to subtract is less than
    the number of rows. They are squared in two limbs: their sums are exact, whatever the order of
    the rows, and the one rounding is that of the result.
    """
    whole, times = cents(F.col("v")), F.col("n").cast("decimal(15,0)")
    known = counts.filter("v IS NOT NULL").select("measure", whole.alias("x"), times.alias("n"))
    x = F.col("x").cast("decimal(19,0)")
    sums = known.groupBy("measure").agg(
        F.sum("n").cast("bigint").alias("count"), F.sum(x * F.col("n")).alias("sum_cents")
    )
    mean = F.call_function("div", F.col("sum_cents"), F.col("count").cast("decimal(19,0)"))
    centred = sums.withColumn("centre", mean.cast("decimal(19,0)"))  # a row per measure
    high, low = _limbs(F.abs(x - F.col("centre")))
    squares = known.join(F.broadcast(centred.select("measure", "centre")), "measure").select(
        "measure", "n", high.alias("high"), low.alias("low")
    )

    def product(a: str, b: str) -> Column:
        return F.sum((F.col(a) * F.col(b)).cast("decimal(22,0)") * F.col("n")).cast("double")

    total = (
        product("high", "high") * float(_LIMB) ** 2 + product("high", "low") * (2.0 * _LIMB)
        + product("low", "low")
    )
    parts = squares.groupBy("measure").agg(total.alias("squares"))
    size = F.col("count")
    rest = (F.col("sum_cents") - F.col("centre") * size.cast("decimal(15,0)")).cast("double")
    spread = F.sqrt((F.col("squares") - rest * rest / size) / F.nullif(size - 1, F.lit(0)))
    return centred.join(F.broadcast(parts), "measure").select(
        "measure", "count", "sum_cents", (spread / 100).alias("std")
    )


def numeric(raw: DataFrame) -> DataFrame:
    """Count, mean, deviation, quartiles and rule counts of the three measures.

    One pass over the text leaves each measure's distinct values with their counts; all the rest
    follows from those, for all measures together.
    """
    cells = [F.struct(F.lit(n).alias("measure"), F.col(n).alias("v")) for n in MEASURES]
    counts = checkpointed(
        _numbers(raw)
        .select(F.inline(F.array(*cells)))
        .groupBy("measure", "v")
        .agg(F.count("*").alias("n"))
    )
    whole = counts.withColumn("cents", cents(F.col("v")))
    found = selection.quantiles(whole, "measure", "cents", "n", QUARTILES)
    places = [f"p{round(100 * q)}" for q in QUARTILES]
    nothing = [None] * len(QUARTILES)
    quartiles = raw.sparkSession.createDataFrame(
        [(m, *[q if q is None else float(q / 100) for q in found.get(m, nothing)]) for m in MEASURES],
        "measure string, " + ", ".join(f"{p} double" for p in places),
    )
    v, n = F.col("v"), F.col("n")

    def rows(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, n)), F.lit(0))

    rest = counts.groupBy("measure").agg(
        F.min(v).alias("min"), F.max(v).alias("max"),
        rows(v.isNull()).alias("non_numeric"), rows(v <= 0).alias("non_positive"),
    )
    size = F.col("count")
    return (  # a row per measure on every side
        quartiles.join(F.broadcast(moments(counts)), "measure", "left")
        .join(F.broadcast(rest), "measure", "left")
        .select(
            "measure", F.coalesce(size, F.lit(0)).alias("count"),
            ratio(F.col("sum_cents").cast("decimal(28,0)"), size * 100, 5).alias("mean"),
            F.round("std", 4).cast("decimal(18,4)").alias("std"),
            "min",
            *[F.round(p, 3).cast("decimal(18,3)").alias(p) for p in places],
            "max",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("non_numeric", "non_positive")],
        )
    )


def dates(raw: DataFrame) -> DataFrame:
    days = raw.select(
        strict_date(F.col("order_date")).alias("d"),
        is_strict_time(F.col("order_time")).alias("ok"),
    )
    return days.agg(
        F.count_if(F.col("d").isNull()).alias("bad_order_date"),
        F.count_if(~F.col("ok")).alias("bad_order_time"),
        F.min("d").alias("first_date"),
        F.max("d").alias("last_date"),
        F.countDistinct("d").alias("days_covered"),
    )


def rules(raw: DataFrame) -> DataFrame:
    """Lines that break price x quantity; a value that does not parse breaks the rule too."""
    expected = amount(F.col("_unit"), F.col("_quantity"))
    parsed = raw.select(
        "item_name_id", "item_name", _number("unit_price").alias("_unit"),
        _number("quantity").alias("_quantity"), _number("total_price").alias("_total"),
    )
    holds = F.coalesce(expected == F.col("_total"), F.lit(False))
    return tallies(
        parsed, {"item_name_ids": ["item_name_id"], "item_names": ["item_name"]},
        {"price_rule_breaks": ~holds},
    ).select("price_rule_breaks", "item_name_ids", "item_names")


def functional_dependencies(raw: DataFrame) -> DataFrame:
    """Keys with more than one value, per attribute.

    A key has several values exactly when its least differs from its greatest. Lines are first
    reduced to distinct combinations, so a frequent product weighs no more than a rare one.
    """
    combos = raw.select("item_name_id", *FD_COLUMNS).distinct()
    spread = combos.groupBy("item_name_id").agg(
        *[(F.min(c) != F.max(c)).alias(c) for c in FD_COLUMNS]
    )
    sums = spread.agg(*[F.count_if(c).alias(c) for c in FD_COLUMNS])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("conflicting_keys"))
             for c in FD_COLUMNS]
    return sums.select(F.inline(F.array(*cells)))


def redundancy(raw: DataFrame) -> DataFrame:
    return tallies(raw, {"distinct_recipes": ["item_ingredients"]})
