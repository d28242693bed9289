"""Dimensions of the star schema."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.calendar import calendar_columns, hour_columns
from tillstar.functions.money import cents, from_cents
from tillstar.functions.text import (
    contains_any,
    drop_suffix,
    filled_parts,
    title_case,
    with_clean_text,
)
from tillstar.operators.ordered import ONE_TASK_ROWS, number_rows
from tillstar.schemas import CHEESE_WORDS, MEAT_WORDS, SIZE_LABELS, SIZE_ORDER, TABLES

SIZE_SUFFIX = r"_(s|m|l|xl|xxl)$"


def typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table]])


def date_dimension(lines: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last order, with or without sales."""
    span = lines.agg(
        F.min(F.col("order_ts").cast("date")).alias("lo"),
        F.max(F.col("order_ts").cast("date")).alias("hi"),
    ).filter(F.col("lo").isNotNull())
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    return typed(
        days.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()]), "dim_date"
    )


def time_dimension(spark: SparkSession) -> DataFrame:
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    return typed(
        hours.select(*[c.alias(n) for n, c in hour_columns(F.col("h")).items()]), "dim_time"
    )


def _lookup(c: Column, values: dict) -> Column:
    entries = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), c)


def item_attributes(
    lines: DataFrame, noun: str = "item", size_suffix: str = SIZE_SUFFIX
) -> DataFrame:
    """One row per natural key: first attributes, price range, derived attributes; no key yet.

    Lines are reduced twice by counts per distinct value, which combine before the shuffle, so a
    product with a third of all lines costs no more than its number of distinct prices.
    """
    attributes = ["item_name", "item_category", "item_size", "item_ingredients"]
    versions = lines.groupBy("item_name_id", *attributes).agg(F.min("item_id").alias("seen"))
    first = versions.groupBy("item_name_id").agg(
        F.min(F.struct("seen", *attributes)).alias("v")
    ).select("item_name_id", *[F.col(f"v.{a}").alias(a) for a in attributes])

    prices = lines.groupBy("item_name_id", cents(F.col("unit_price")).alias("c")).agg(
        F.count("*").alias("n")
    )
    middle = F.floor(F.percentile("c", F.lit(0.5), F.col("n")) + 0.5)
    spread = prices.groupBy("item_name_id").agg(
        from_cents(middle).alias("unit_price"),
        from_cents(F.min("c")).alias("min_unit_price"),
        from_cents(F.max("c")).alias("max_unit_price"),
    )
    named = noun.capitalize()
    recipe = F.col("item_ingredients")
    return first.join(spread, "item_name_id").withColumns(
        {
            "product_code": drop_suffix(F.col("item_name_id"), size_suffix),
            "item_short_name": drop_suffix(
                drop_suffix(F.col("item_name"), r"^The\s+"), rf"\s+{named}$"
            ),
            "size_label": _lookup(F.col("item_size"), SIZE_LABELS),
            "size_sort_order": _lookup(F.col("item_size"), SIZE_ORDER),
            "price_is_stable": F.col("max_unit_price") - F.col("min_unit_price")
            <= F.lit(Decimal("0.01")),
            "ingredient_count": F.size(filled_parts(recipe)),
            "is_vegetarian": ~contains_any(recipe, MEAT_WORDS),
        }
    )


def item_dimension(
    attributes: DataFrame, rows: int | None = None, limit: int = ONE_TASK_ROWS
) -> DataFrame:
    """Surrogate keys 1..n in a fixed sort order, so a rerun gives the same keys."""
    order = ["product_code", "size_sort_order", "item_name_id"]
    return typed(number_rows(attributes, order, "item_key", rows, limit), "dim_item")


def recipe_parts(items: DataFrame) -> DataFrame:
    """(item_key, ingredient_name), one row per listed ingredient.

    Recipes repeat over sizes, so the text is cleaned once per distinct recipe.
    """
    recipes = items.select("item_ingredients").distinct()
    parts = recipes.select(
        "item_ingredients",
        F.explode(F.split("item_ingredients", ",")).alias("part"),
    )
    named = parts.select("part", F.col("part").alias("ingredient_name")).distinct()
    named = with_clean_text(named, ["ingredient_name"]).withColumn(
        "ingredient_name", title_case(F.col("ingredient_name"))
    ).filter(F.col("ingredient_name") != "")
    return (
        items.select("item_key", "item_ingredients")
        .join(parts.join(named, "part"), "item_ingredients")
        .select("item_key", "ingredient_name")
    )


def ingredient_dimension(
    parts: DataFrame, rows: int | None = None, limit: int = ONE_TASK_ROWS
) -> DataFrame:
    names = parts.select("ingredient_name").distinct().withColumn(
        "is_cheese", contains_any(F.col("ingredient_name"), CHEESE_WORDS)
    )
    return typed(
        number_rows(names, ["ingredient_name"], "ingredient_key", rows, limit), "dim_ingredient"
    )


def ingredient_bridge(parts: DataFrame, ingredients: DataFrame) -> DataFrame:
    return typed(
        parts.join(ingredients, "ingredient_name").dropDuplicates(["item_key", "ingredient_key"]),
        "bridge_item_ingredient",
    )
