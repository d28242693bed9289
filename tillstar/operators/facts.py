"""The order-line fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.calendar import date_key
from tillstar.operators.dimensions import typed
from tillstar.operators.groups import with_totals


def order_context(lines: DataFrame) -> DataFrame:
    """Lines, units and value of the whole order on each of its lines."""
    totals = {
        "order_line_count": F.count("*"),
        "order_item_count": F.sum("quantity"),
        "order_total_value": F.sum("total_price"),
    }
    return with_totals(lines, ["order_id"], totals)


def fact_order_items(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Surrogate keys and order context on every line; text stays in the dimensions.

    The order context comes first: it then counts orders on the lines as written, not on a join.
    What follows from a column of the line is worked out last and not shuffled.
    """
    narrow = lines.select(
        F.col("item_id").alias("order_item_id"),
        "order_id",
        "item_name_id",
        "order_ts",
        "quantity",
        "unit_price",
        "total_price",
        "total_price_source",
        "price_variance_flag",
    )
    keyed = order_context(narrow).join(
        items.select("item_key", "item_name_id"), "item_name_id", "left"
    )
    dated = keyed.withColumns({"date_key": date_key(F.col("order_ts")), "time_key": F.hour("order_ts")})
    return typed(dated, "fact_order_items")


def require_no_orphans(fact: DataFrame) -> None:
    """Raise if a line found no item. The dimension comes from the lines, so this is a guard."""
    lost = fact.filter("item_key IS NULL").select("order_item_id").limit(5).collect()
    if lost:
        raise RuntimeError(f"lines without an item, among them {[r.order_item_id for r in lost]}")
