"""Parse raw text rows, give each bad row the first rule it breaks, keep the rest.

Rules apply in order and each sees only what the earlier ones left. The rules on single rows are
one expression; the two duplicate rules each add one pass, over the keys of rows that are still good.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.calendar import is_strict_time, strict_date, timestamp_of
from tillstar.functions.money import amount, differs
from tillstar.functions.text import title_case, with_clean_text
from tillstar.operators.groups import keep_first, mark_repeats
from tillstar.schemas import RAW_COLUMNS, SIZE_ORDER

TEXT_COLUMNS = ["item_name_id", "item_size", "item_category", "item_ingredients", "item_name"]
SUMMARY = ["source_rows", "rejected_rows", "fact_rows", "price_variances"]
LINE_KEY = ["item_id"]
LINE_CONTENT = ["order_id", "item_name_id", "order_time", "quantity"]
#: What :func:`with_amounts` reads.
CLEAN_COLUMNS = [
    "item_id", "order_id", "item_name_id", "order_ts", "quantity", "unit_price", "total_price",
    "item_size", "item_category", "item_ingredients", "item_name",
]

#: Up to so many rows, the bitmaps of what a duplicate rule keeps (a bit for each row) are broadcast.
BROADCAST_ROWS = 1_000_000_000


def _number(c: Column) -> Column:
    return F.trim(c).try_cast("decimal(38,10)")


def whole_number(c: Column) -> Column:
    """A 64-bit integer from text such as ``7`` or ``7.0``; NULL for anything else."""
    n = _number(c)
    return F.coalesce(c.try_cast("bigint"), F.when(n == F.floor(n), n.try_cast("bigint")))


def price(c: Column, kind: str = "decimal(10,2)") -> Column:
    return F.round(_number(c), 2).try_cast(kind)


def parse_lines(raw: DataFrame) -> DataFrame:
    """Typed columns next to the raw text. Text that does not parse becomes NULL, never a guess."""
    kept = raw.withColumn("raw", F.struct(*RAW_COLUMNS))
    return (
        with_clean_text(kept, TEXT_COLUMNS)
        .withColumns(
            {
                "item_name_id": F.lower("item_name_id"),
                "item_size": F.upper("item_size"),
                "item_category": title_case(F.col("item_category")),
                "item_id": whole_number(F.col("item_id")),
                "order_id": whole_number(F.col("order_id")),
                "quantity": whole_number(F.col("quantity")),
                "unit_price": price(F.col("unit_price")),
                "total_price": price(F.col("total_price"), "decimal(18,2)"),
                "order_day": strict_date(F.col("order_date")),
                "time_ok": is_strict_time(F.col("order_time")),
            }
        )
        .withColumn(
            "order_ts",
            F.when(F.col("time_ok"), timestamp_of(F.col("order_day"), F.col("order_time"))),
        )
    )


def row_rules(noun: str = "item") -> list[tuple[str, Column]]:
    """(reason, broken?) of the rules on single rows, in order."""
    c = F.col
    return [
        ("unparseable identifier", c("item_id").isNull() | c("order_id").isNull()),
        ("unparseable order_date (expected DD-MM-YYYY)", c("order_day").isNull()),
        ("unparseable order_time (expected HH:MM:SS)", ~c("time_ok")),
        ("quantity must be a positive integer", c("quantity").isNull() | (c("quantity") <= 0)),
        ("unit_price must be positive", c("unit_price").isNull() | (c("unit_price") <= 0)),
        (f"unknown {noun}_size", ~c("item_size").isin(*SIZE_ORDER)),
        ("missing product key", c("item_name_id") == ""),
    ]


def first_reason(noun: str = "item") -> Column:
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in row_rules(noun)])


def duplicate_reasons(noun: str = "item") -> list[tuple[str, list[str]]]:
    return [
        (f"duplicate {noun}_id", LINE_KEY),
        ("duplicate line item within order", LINE_CONTENT),
    ]


def judge_lines(
    raw: DataFrame,
    order: str = "_row",
    noun: str = "item",
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
    known: dict[str, DataFrame] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Every raw row, typed, with ``reject_reason`` (NULL for good rows).

    ``order`` must be unique per row. A duplicate rule looks at its key columns alone, of the rows
    that the rules before it left. ``stage`` writes the parsed rows once, so that none of this
    parses text again; rows get numbers as they are written, and what a rule keeps comes back as
    bitmaps over these numbers, written too, so the rows themselves are not shuffled and no rule
    runs twice. Without ``stage`` the few repeats are joined to the rows by ``order``. ``known``
    has, for a duplicate rule's reason, keys that count as seen before the first row. ``unique`` says
    that ``order`` is unique for certain, so written rows are not searched for some that share it.
    """
    typed = parse_lines(raw).withColumn("reject_reason", first_reason(noun))
    rules, known = duplicate_reasons(noun), known or {}
    if stage is None:
        return _judged_by_join(typed, order, rules, known)
    return _judged_as_written(typed, order, rules, known, stage, unique)


def _judged_by_join(
    typed: DataFrame, order: str, rules: list[tuple[str, list[str]]], known: dict[str, DataFrame]
) -> DataFrame:
    keys = typed.select(order, *dict.fromkeys([*LINE_KEY, *LINE_CONTENT]), "reject_reason")
    for reason, columns in rules:
        alive = F.col("reject_reason").isNull()
        if reason in known:
            seen = known[reason].distinct().withColumn("_seen", F.lit(reason))
            keys = keys.join(seen, columns, "left").withColumn(
                "reject_reason", F.coalesce("reject_reason", "_seen")
            ).drop("_seen")
        marked = mark_repeats(keys, columns, order, alive, "_repeat")
        keys = marked.withColumn(
            "reject_reason", F.when(F.col("_repeat"), reason).otherwise(F.col("reject_reason"))
        ).drop("_repeat")
    repeats = keys.filter(
        F.col("reject_reason").isin(*[reason for reason, _ in rules])
    ).select(order, F.col("reject_reason").alias("_repeat"))
    return typed.join(repeats, order, "left").withColumn(
        "reject_reason", F.coalesce("reject_reason", "_repeat")
    ).drop("_repeat")


def _judged_as_written(
    typed: DataFrame, order: str, rules: list[tuple[str, list[str]]], known: dict[str, DataFrame],
    stage: Callable[[DataFrame, str], DataFrame], unique: bool,
) -> DataFrame:
    row, columns = "_place", typed.columns
    typed = stage(typed.withColumn(row, F.monotonically_increasing_id()), "judged")
    typed = typed.withColumn("_own", F.col("reject_reason"))
    small = typed.count() <= BROADCAST_ROWS
    for number, (reason, keys) in enumerate(rules):
        left = typed.filter("reject_reason IS NULL").select(*dict.fromkeys([order, row, *keys]))
        if reason in known:
            left = left.join(known[reason], keys, "left_anti")
        kept = keep_first(left, keys, [order], ties=True)
        bits = stage(bitmaps(kept, row), f"kept-{number}")
        repeat = F.when(~F.col("_kept"), reason)
        typed = kept_by_bits(typed, bits, row, small).withColumn(
            "reject_reason", F.coalesce("reject_reason", repeat)
        ).drop("_kept")
    if unique:
        return typed.select(*columns)
    # Where several repeats share their order, each row with it comes once for each of them, as in a join.
    repeats = typed.filter("_own IS NULL AND reject_reason IS NOT NULL").groupBy(order).agg(
        *[F.count_if(F.col("reject_reason") == reason).alias(f"_n{i}") for i, (reason, _) in enumerate(rules)]
    )
    times = [F.col(f"_n{i}").cast("int") for i in range(len(rules))]
    shared = stage(repeats.filter(reduce(add, times) > 1), "shared-order")
    each = F.flatten(F.array(*[
        F.array_repeat(F.lit(reason), n) for (reason, _), n in zip(rules, times)
    ]))
    reasons = F.when(times[0].isNull(), F.array("reject_reason")).otherwise(
        F.transform(each, lambda reason: F.coalesce("_own", reason))
    )
    judged = typed.join(shared, order, "left").withColumn("reject_reason", F.explode(reasons))
    return judged.select(*columns)


def bitmaps(kept: DataFrame, row: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Row numbers as bitmaps of 32,768 numbers each; by ``within``, if numbers are unique there.

    Numbers are shuffled before bitmaps are made of them: combined on the map side, every task
    would send a part of every bitmap.
    """
    bucket, position = F.bitmap_bucket_number(F.col(row)), F.bitmap_bit_position(F.col(row))
    place = [*within, "_bucket"]
    numbers = kept.select(*within, bucket.alias("_bucket"), position.alias("_at")).repartition(*place)
    return numbers.groupBy(*place).agg(F.bitmap_construct_agg("_at").alias("_bits"))


def kept_by_bits(
    rows: DataFrame, bits: DataFrame, row: str, small: bool, within: tuple[str, ...] = ()
) -> DataFrame:
    """Rows with ``_kept``: is the row's number among those of the bitmaps?"""
    bucket, position = F.bitmap_bucket_number(F.col(row)), F.bitmap_bit_position(F.col(row))
    # Bit 0 is the lowest of the first byte, and words are read with the first byte highest. A bitmap
    # is made into words once, so that looking at a row's bit is a shift; a missing one has no bits.
    words = bits.withColumn("_bits", F.transform(F.sequence(F.lit(0), F.lit(1023)), _word))
    word = F.get("_bits", F.shiftright(position, 5).cast("int"))
    bit = F.getbit(word, F.pmod(position, F.lit(32)).bitwiseXOR(F.lit(24)).cast("int"))
    return (
        rows.withColumn("_bucket", bucket)
        .join(F.broadcast(words) if small else words, [*within, "_bucket"], "left")
        .withColumn("_kept", F.coalesce(bit == 1, F.lit(False)))
        .select(*rows.columns, "_kept")
    )


def _word(i: Column) -> Column:
    """Four bytes of a bitmap as a signed number."""
    number = F.conv(F.hex(F.substring(F.col("_bits"), i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    return F.when(number < 2**31, number).otherwise(number - 2**32).cast("int")


def rejected_rows(judged: DataFrame) -> DataFrame:
    """The quarantine table: the raw columns as they came, and the reason."""
    return judged.filter(F.col("reject_reason").isNotNull()).select("raw.*", "reject_reason")


def good_lines(judged: DataFrame) -> DataFrame:
    return with_amounts(judged.filter(F.col("reject_reason").isNull()))


def clean_lines(
    raw: DataFrame, order: str = "_row", noun: str = "item",
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Only the good rows. Cheaper than :func:`judge_lines`: repeats die before the shuffle.

    ``stage`` writes the rows that the rules on single rows leave once. The duplicate rules then
    shuffle keys alone, and what they keep comes back as bitmaps over the written rows.
    """
    good = parse_lines(raw).filter(first_reason(noun).isNull()).drop("raw")
    rules = [keys for _, keys in duplicate_reasons(noun)]
    if stage is None:
        for keys in rules:
            good = keep_first(good, keys, [order])
        return with_amounts(good)
    row = "_place"
    needed = dict.fromkeys([order, *LINE_KEY, *LINE_CONTENT, *CLEAN_COLUMNS])
    good = stage(good.select(*needed, F.monotonically_increasing_id().alias(row)), "good")
    small = good.count() <= BROADCAST_ROWS
    for number, keys in enumerate(rules):
        kept = keep_first(good.select(*dict.fromkeys([order, row, *keys])), keys, [order])
        bits = stage(bitmaps(kept, row), f"kept-{number}")
        good = kept_by_bits(good, bits, row, small).filter("_kept").drop("_kept")
    return with_amounts(good)


def with_amounts(lines: DataFrame) -> DataFrame:
    """Recompute the line amount, keep the supplied one, flag rows where they disagree."""
    total = amount(F.col("unit_price"), F.col("quantity"))
    return lines.select(
        "item_id",
        "order_id",
        "item_name_id",
        "order_ts",
        F.col("quantity").cast("int").alias("quantity"),
        "unit_price",
        total.alias("total_price"),
        F.col("total_price").alias("total_price_source"),
        differs(total, F.coalesce(F.col("total_price"), F.lit(0))).alias("price_variance_flag"),
        "item_size",
        "item_category",
        "item_ingredients",
        "item_name",
    )


def reject_summary(judged: DataFrame) -> DataFrame:
    return (
        judged.filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count("*").alias("rejected"))
    )


def _summary() -> list[Column]:
    good = F.col("reject_reason").isNull()
    total = amount(F.col("unit_price"), F.col("quantity"))
    off = differs(total, F.coalesce(F.col("total_price"), F.lit(0)))
    return [
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(~good).alias("rejected_rows"),
        F.count_if(good).alias("fact_rows"),
        F.count_if(good & off).alias("price_variances"),
    ]


def run_summary(judged: DataFrame) -> DataFrame:
    return judged.agg(*_summary())


def staged_with_summary(
    judged: DataFrame, stage: Callable[[DataFrame, str], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """The judged rows, written, and their run summary, counted while they were written."""
    seen = Observation()
    written = stage(judged.observe(seen, *_summary()), "outcome")
    summary = judged.sparkSession.createDataFrame(
        [tuple(seen.get[c] for c in SUMMARY)], ", ".join(f"{c} bigint" for c in SUMMARY)
    )
    return written, summary


def good_counts() -> list[Column]:
    """What the run summary has of the good lines (see :func:`good_lines`)."""
    return [
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if("price_variance_flag").alias("price_variances"),
    ]


def summary_of(spark: SparkSession, good: dict[str, int], bad: dict[str, int]) -> DataFrame:
    """The run summary from counts of good lines and of rejected rows, seen while they were written."""
    counts = {**good, **bad, "source_rows": good["fact_rows"] + bad["rejected_rows"]}
    return spark.createDataFrame(
        [tuple(counts[c] for c in SUMMARY)], ", ".join(f"{c} bigint" for c in SUMMARY)
    ).coalesce(1)
