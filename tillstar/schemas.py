"""Column contracts, table schemas and key constraints of the star schema.

Inside the library the sold thing is called ``item``. A source file usually carries its own
noun in its column names (``<noun>_id``, ``<noun>_size`` ...), and its users expect that noun in
the tables and views, so reading and publishing take a ``noun``: :func:`to_item_names` renames on
the way in, :func:`from_item_names` on the way out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The twelve text columns of a raw order-line file, with the noun ``item``.
RAW_COLUMNS = [
    "item_id",
    "order_id",
    "item_name_id",
    "quantity",
    "order_date",
    "order_time",
    "unit_price",
    "total_price",
    "item_size",
    "item_category",
    "item_ingredients",
    "item_name",
]

# The size domain, its labels and its sort order.
SIZE_LABELS = {
    "S": "Small",
    "M": "Medium",
    "L": "Large",
    "XL": "Extra Large",
    "XXL": "Double Extra Large",
}
SIZE_ORDER = {"S": 1, "M": 2, "L": 3, "XL": 4, "XXL": 5}

# First hour, last hour and name of each part of the trading day.
DAY_PARTS = [
    (0, 10, "Pre-Opening"),
    (11, 13, "Lunch"),
    (14, 16, "Afternoon"),
    (17, 20, "Dinner"),
    (21, 23, "Late Night"),
]
PEAK_DAY_PARTS = ("Lunch", "Dinner")

# The category domain that the quality gate expects.
CATEGORY_DOMAIN = ("Classic", "Supreme", "Veggie", "Chicken")

# Words that mark a recipe as not vegetarian, or an ingredient as cheese.
MEAT_WORDS = (
    "chicken", "ham", "bacon", "pepperoni", "salami", "beef", "prosciutto", "capocollo",
    "soppressata", "nduja", "anchov", "calabrese", "chorizo", "sausage", "barbecued chicken",
)
CHEESE_WORDS = (
    "cheese", "mozzarella", "provolone", "gouda", "romano", "feta", "ricotta", "asiago",
    "parmigiano", "goat",
)

# Columns that carry the noun, as templates.
_NOUN_COLUMNS = [
    "{}_id", "{}_key", "{}_name_id", "{}_name", "{}_short_name", "{}_category", "{}_size",
    "{}_ingredients", "order_{}_count", "{}s_sold", "total_{}s_sold", "avg_{}s_per_order",
    "{}s_in_order",
]
_NOUN_TABLES = ["dim_{}", "bridge_{}_ingredient"]


def raw_columns(noun: str = "item") -> list[str]:
    names = {t.format("item"): t.format(noun) for t in _NOUN_COLUMNS}
    return [names.get(c, c) for c in RAW_COLUMNS]


def raw_schema(noun: str = "item") -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in raw_columns(noun)])


def to_item_names(df: DataFrame, noun: str) -> DataFrame:
    return df.withColumnsRenamed({t.format(noun): t.format("item") for t in _NOUN_COLUMNS})


def from_item_names(df: DataFrame, noun: str) -> DataFrame:
    return df.withColumnsRenamed({t.format("item"): t.format(noun) for t in _NOUN_COLUMNS})


def table_name(name: str, noun: str) -> str:
    return {t.format("item"): t.format(noun) for t in _NOUN_TABLES}.get(name, name)


MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(10, 2)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns])


_INT, _LONG, _TEXT, _BOOL = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()

# The columns of the published tables.
TABLES: dict[str, T.StructType] = {
    "dim_date": _table(
        ("date_key", _INT), ("full_date", T.DateType()), ("year", _INT), ("quarter", _INT),
        ("quarter_name", _TEXT), ("month_number", _INT), ("month_name", _TEXT),
        ("month_short", _TEXT), ("year_month", _TEXT), ("iso_week", _INT),
        ("day_of_month", _INT), ("day_of_week", _INT), ("day_name", _TEXT),
        ("day_short", _TEXT), ("is_weekend", _BOOL), ("day_of_year", _INT),
    ),
    "dim_time": _table(
        ("time_key", _INT), ("hour_24", _INT), ("hour_label", _TEXT), ("hour_12", _TEXT),
        ("day_part", _TEXT), ("is_peak_window", _BOOL),
    ),
    "dim_item": _table(
        ("item_key", _LONG), ("item_name_id", _TEXT), ("product_code", _TEXT),
        ("item_name", _TEXT), ("item_short_name", _TEXT), ("item_category", _TEXT),
        ("item_size", _TEXT), ("size_label", _TEXT), ("size_sort_order", _INT),
        ("unit_price", PRICE), ("min_unit_price", PRICE), ("max_unit_price", PRICE),
        ("price_is_stable", _BOOL), ("ingredient_count", _INT), ("is_vegetarian", _BOOL),
        ("item_ingredients", _TEXT),
    ),
    "dim_ingredient": _table(
        ("ingredient_key", _LONG), ("ingredient_name", _TEXT), ("is_cheese", _BOOL),
    ),
    "bridge_item_ingredient": _table(("item_key", _LONG), ("ingredient_key", _LONG)),
    "fact_order_items": _table(
        ("order_item_id", _LONG), ("order_id", _LONG), ("date_key", _INT), ("time_key", _INT),
        ("item_key", _LONG), ("order_ts", T.TimestampNTZType()), ("quantity", _INT),
        ("unit_price", PRICE), ("total_price", MONEY), ("total_price_source", MONEY),
        ("price_variance_flag", _BOOL), ("order_line_count", _LONG),
        ("order_item_count", _LONG), ("order_total_value", MONEY),
    ),
}

TABLES["rejected_rows"] = _table(*[(c, _TEXT) for c in [*RAW_COLUMNS, "reject_reason"]])

# Parents before children.
LOAD_ORDER = [
    "dim_date", "dim_time", "dim_item", "dim_ingredient", "bridge_item_ingredient",
    "fact_order_items", "rejected_rows",
]


@dataclass(frozen=True)
class Keys:
    """Declared constraints of one table; the quality gate turns each into a check."""

    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    foreign: tuple[tuple[str, str], ...] = ()


CONSTRAINTS: dict[str, Keys] = {
    "dim_date": Keys(
        unique=(("date_key",), ("full_date",)),
        required=tuple(TABLES["dim_date"].fieldNames()),
    ),
    "dim_time": Keys(unique=(("time_key",),), required=tuple(TABLES["dim_time"].fieldNames())),
    "dim_item": Keys(
        unique=(("item_key",), ("item_name_id",)),
        required=tuple(TABLES["dim_item"].fieldNames()),
        positive=("unit_price",),
    ),
    "dim_ingredient": Keys(
        unique=(("ingredient_key",), ("ingredient_name",)),
        required=("ingredient_key", "ingredient_name", "is_cheese"),
    ),
    "bridge_item_ingredient": Keys(
        unique=(("item_key", "ingredient_key"),),
        required=("item_key", "ingredient_key"),
        foreign=(("item_key", "dim_item"), ("ingredient_key", "dim_ingredient")),
    ),
    "fact_order_items": Keys(
        unique=(("order_item_id",),),
        required=tuple(
            c for c in TABLES["fact_order_items"].fieldNames() if c != "total_price_source"
        ),
        positive=("quantity", "unit_price", "total_price"),
        foreign=(("date_key", "dim_date"), ("time_key", "dim_time"), ("item_key", "dim_item")),
    ),
}
