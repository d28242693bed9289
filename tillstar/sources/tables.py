"""Order lines taken from the retail and event tables, in the shape the library works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.calendar import date_key
from tillstar.functions.text import title_case
from tillstar.operators.groups import keep_first
from tillstar.operators.quarantine import with_amounts

# The retail item key ends in part number and size; what is left is the brand.
RETAIL_SUFFIX = r"_\d+_(s|m|l|xl|xxl)$"

# A fixed order of the copies of a line: all its columns.
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_linenumber",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_band(size: Column) -> Column:
    return (
        F.when(size <= 10, "S")
        .when(size <= 20, "M")
        .when(size <= 30, "L")
        .when(size <= 40, "XL")
        .otherwise("XXL")
    )


def _product_columns() -> dict[str, Column]:
    size = size_band(F.col("p_size"))
    return {
        "item_size": size,
        "item_name_id": F.concat_ws("_", F.lower("p_brand"), "p_partkey", F.lower(size)),
        "item_category": title_case(F.col("p_type")),
        "item_ingredients": F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")),
        "item_name": F.concat(F.lit("The "), F.col("p_brand"), F.lit(" Item")),
    }


def _line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _unit_price() -> Column:
    """Null for a quantity of 0. Lines that are no sale stay in; the quality gate tells of them."""
    return F.round(
        F.try_divide(
            F.col("l_extendedprice").cast("decimal(12,2)"),
            F.col("l_quantity").cast("decimal(10,0)"),
        ),
        2,
    ).cast("decimal(10,2)")


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean order lines of ``lineitem``, with date from ``orders`` and product from ``part``.

    Both duplicate rules look at line columns only, so they run before the joins: copies shrink
    map-side, the narrow rows shuffle, and the joins that follow are plain enough for Spark to
    split a skewed key. Neither joined table is forced to broadcast; both grow with the data. Dates
    are joined first, so that no product text is shuffled along with the lines.
    """
    lines = table(spark, sf_dir, "lineitem")
    lines = keep_first(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    lines = keep_first(lines, ["l_orderkey", "l_partkey", "l_quantity"], LINE_ORDER)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", *[
        c.alias(n) for n, c in _product_columns().items()
    ])
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return with_amounts(
        joined.withColumns(
            {
                "item_id": _line_id(),
                "order_id": F.col("l_orderkey"),
                "order_ts": F.col("o_orderdate").cast("timestamp_ntz"),
                "quantity": F.col("l_quantity"),
                "unit_price": _unit_price(),
                "total_price": F.col("l_extendedprice").cast("decimal(18,2)"),
            }
        )
    )


def retail_text(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    """The same lines as twelve raw text columns, with some fields spoilt by key arithmetic.

    ``_row`` orders the copies of a line by content; the place in the scan makes it unique. It is
    taken right at the scan, so a retried task numbers its rows the same way. ``lines`` may be a
    stream of ``lineitem``. Dates are joined first, so that no text is shuffled along.
    """
    return as_text(dated_lines(spark, sf_dir, lines))


def dated_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """What :func:`as_text` needs of the lines, their orders and parts, as the tables have it."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    lines = lines.withColumn("place", F.monotonically_increasing_id())
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        "l_orderkey", *LINE_ORDER, "place", "o_orderdate", "p_name", "p_brand", "p_type", "p_size"
    )


def as_text(dated: DataFrame) -> DataFrame:
    """The twelve raw text columns and ``_row`` of :func:`dated_lines`; row by row."""
    joined = dated.withColumn("p_partkey", F.col("l_partkey")).withColumns(
        {n: c for n, c in _product_columns().items() if n != "item_category"}
    )
    key = F.col("l_orderkey")
    mixed = key + F.col("l_suppkey")
    spoilt_date = F.when(key % 97 == 1, F.date_format("o_orderdate", "yyyy/MM/dd"))
    two = [F.lpad((key % n).cast("string"), 2, "0") for n in (24, 60)]
    clock = F.when(key >= 0, F.concat(two[0], F.lit(":"), two[1], F.lit(":00"))).otherwise(
        F.format_string("%02d:%02d:00", key % 24, key % 60)
    )
    return joined.select(
        F.when(key % 71 == 6, "x").otherwise(_line_id().cast("string")).alias("item_id"),
        key.cast("string").alias("order_id"),
        F.when(key % 73 == 5, " ").otherwise(F.upper("item_name_id")).alias("item_name_id"),
        F.when(mixed % 89 == 2, "0")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.coalesce(spoilt_date, F.date_format("o_orderdate", "dd-MM-yyyy")).alias("order_date"),
        F.when(key % 67 == 7, "25:00:00").otherwise(clock).alias("order_time"),
        F.when(mixed % 83 == 3, "n/a").otherwise(_unit_price().cast("string")).alias("unit_price"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("total_price"),
        F.when(key % 79 == 4, "Q").otherwise(F.lower("item_size")).alias("item_size"),
        F.col("p_type").alias("item_category"),
        "item_ingredients",
        "item_name",
        F.struct(*LINE_ORDER, "place").alias("_row"),
    )


def event_lines(events: DataFrame) -> DataFrame:
    """Order lines of ``events``, the table with a time of day: one basket per user and day."""
    kind = F.col("event_type")
    day = F.col("ts").cast("date")
    return events.select(
        F.col("event_id").alias("item_id"),
        (F.col("user_id") * 100000000 + date_key(day)).alias("order_id"),
        F.concat(kind, F.lit("_m")).alias("item_name_id"),
        F.col("ts").cast("timestamp_ntz").alias("order_ts"),
        F.lit(1).alias("quantity"),
        F.col("value").cast("decimal(10,2)").alias("unit_price"),
        F.col("value").cast("decimal(18,2)").alias("total_price"),
        F.lit("M").alias("item_size"),
        title_case(kind).alias("item_category"),
        kind.alias("item_ingredients"),
        F.concat(F.lit("The "), title_case(kind), F.lit(" Item")).alias("item_name"),
    )


def counter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean order lines of ``events``."""
    lines = event_lines(table(spark, sf_dir, "events"))
    lines = keep_first(lines, ["item_id"], ["order_id", "item_name_id", "order_ts"])
    lines = keep_first(lines, ["order_id", "item_name_id", "order_ts", "quantity"], ["item_id"])
    return with_amounts(lines)
