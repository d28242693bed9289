"""The reporting views: one function per view, from the star schema to a frame.

Money and shares are exact decimals rounded half up. Whatever can be reduced before a join is: the
fact is summed per item key first, so text attributes meet a handful of rows instead of every line.
Windows without partitions run over days, months or hours only, whose number is bounded by
the calendar; product results go through the range-wise ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.bands import abc_class
from tillstar.functions.money import growth, money, percent, ratio, sum_money
from tillstar.operators.affinity import basket_affinity
from tillstar.operators.ordered import ONE_TASK_ROWS, rank_from_top
from tillstar.plans.star import Star, enriched


def count_distinct(c: str) -> Column:
    return F.countDistinct(c)


def _sales() -> list[Column]:
    return [sum_money(F.col("total_price")).alias("revenue"), F.sum("quantity").alias("items_sold")]


def per_item(fact: DataFrame) -> DataFrame:
    """Sums per item key, the smallest grain that any product question needs."""
    return fact.groupBy("item_key").agg(
        *_sales(),
        F.count("*").alias("lines"),
        sum_money(F.col("unit_price")).alias("price_sum"),
    )


def trading_days(fact: DataFrame) -> Column:
    """Number of days with sales, as a scalar subquery over the date column alone."""
    return fact.select("date_key").distinct().agg(F.count("*").alias("n")).scalar()


def total_of(df: DataFrame, c: str) -> Column:
    return df.agg(F.sum(c).alias("total")).scalar()


def fact_enriched(star: Star) -> DataFrame:
    # The columns of the view.
    return enriched(star).select(
        "order_item_id", "order_id", "order_ts",
        "full_date", "year", "quarter_name", "year_month", "month_name", "month_number",
        "iso_week", "day_name", "day_of_week", "is_weekend",
        "hour_24", "hour_label", "day_part", "is_peak_window",
        "item_name", "item_short_name", "item_category", "item_size", "size_label",
        "size_sort_order", "is_vegetarian", "ingredient_count",
        "quantity", "unit_price", "total_price",
        "order_line_count", "order_item_count", "order_total_value",
    )


def kpi_headline(star: Star) -> DataFrame:
    """Sums per order first: two distinct counts in one aggregate would copy every line."""
    per_order = star.fact_order_items.groupBy("order_id").agg(
        *_sales(), F.count("*").alias("lines")
    )
    base = per_order.agg(
        F.sum("revenue").alias("revenue"),
        F.sum("items_sold").alias("items_sold"),
        F.count("*").alias("orders"),
        F.sum("lines").alias("lines"),
    ).withColumn("days", trading_days(star.fact_order_items))
    c = F.col
    return base.select(
        money(c("revenue")).alias("total_revenue"),
        c("items_sold").alias("total_items_sold"),
        c("orders").alias("total_orders"),
        c("lines").alias("total_line_items"),
        c("days").alias("trading_days"),
        ratio(c("revenue"), c("orders"), 2).alias("avg_order_value"),
        ratio(c("items_sold"), c("orders"), 2).alias("avg_items_per_order"),
        ratio(c("revenue"), c("days"), 2).alias("avg_revenue_per_day"),
        ratio(c("orders"), c("days"), 1).alias("avg_orders_per_day"),
    )


def per_day(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key").agg(*_sales(), count_distinct("order_id").alias("orders"))


def daily_sales(star: Star) -> DataFrame:
    week = Window.orderBy("full_date").rowsBetween(-6, Window.currentRow)
    c = F.col
    return (
        per_day(star.fact_order_items)
        .join(star.dim_date, "date_key")
        .select(
            "full_date", "day_name", "is_weekend", "year_month", "revenue", "items_sold", "orders",
            ratio(c("revenue"), c("orders"), 2).alias("avg_order_value"),
            ratio(F.sum("revenue").over(week), F.count("*").over(week), 2).alias(
                "revenue_7d_moving_avg"
            ),
        )
    )


def per_month(star: Star) -> DataFrame:
    """An order that spans months counts in each, so orders are counted from the lines."""
    month = star.dim_date.select("date_key", "full_date", "year_month", "month_short")
    return (
        star.fact_order_items.groupBy("date_key", "order_id")
        .agg(*_sales())
        .join(month, "date_key")
        .groupBy("year_month", "month_short")
        .agg(
            F.min("full_date").alias("month_start"),
            money(F.sum("revenue")).alias("revenue"),
            F.sum("items_sold").alias("items_sold"),
            count_distinct("order_id").alias("orders"),
        )
    )


def monthly_trend(star: Star) -> DataFrame:
    c = F.col
    previous = F.lag("revenue").over(Window.orderBy("month_start"))
    whole = F.sum("revenue").over(Window.partitionBy())
    return per_month(star).select(
        "year_month", "month_start", "month_short", "revenue", "items_sold", "orders",
        ratio(c("revenue"), c("orders"), 2).alias("avg_order_value"),
        previous.alias("prev_month_revenue"),
        growth(c("revenue"), previous).alias("mom_growth_pct"),
        percent(c("revenue"), whole).alias("pct_of_year_revenue"),
    )


def orders_by(star: Star, attribute: str) -> DataFrame:
    """Distinct orders per item attribute."""
    return (
        star.fact_order_items.select("order_id", "item_key")
        .join(star.items("item_key", attribute), "item_key")
        .groupBy(attribute)
        .agg(count_distinct("order_id").alias("orders"))
    )


def sales_by_category(star: Star) -> DataFrame:
    items = per_item(star.fact_order_items).join(star.dim_item, "item_key")
    groups = items.groupBy("item_category").agg(
        money(F.sum("revenue")).alias("revenue"),
        F.sum("items_sold").alias("items_sold"),
        count_distinct("product_code").alias("products_offered"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("lines").alias("lines"),
    )
    c = F.col
    return groups.join(orders_by(star, "item_category"), "item_category").select(
        "item_category", "revenue", "items_sold", "orders", "products_offered",
        percent(c("revenue"), total_of(star.fact_order_items, "total_price")).alias(
            "pct_of_revenue"
        ),
        ratio(c("price_sum"), c("lines"), 2).alias("avg_unit_price"),
    )


def sales_by_size(star: Star) -> DataFrame:
    items = per_item(star.fact_order_items).join(star.dim_item, "item_key")
    c = F.col
    return (
        items.groupBy("item_size", "size_label")
        .agg(
            F.min("size_sort_order").alias("size_sort_order"),
            money(F.sum("revenue")).alias("revenue"),
            F.sum("items_sold").alias("items_sold"),
            F.sum("price_sum").alias("price_sum"),
            F.sum("lines").alias("lines"),
        )
        .select(
            "item_size", "size_label", "size_sort_order", "revenue", "items_sold",
            percent(c("revenue"), F.sum("revenue").over(Window.partitionBy())).alias(
                "pct_of_revenue"
            ),
            ratio(c("price_sum"), c("lines"), 2).alias("avg_unit_price"),
        )
    )


def hourly_demand(star: Star) -> DataFrame:
    """Orders per day divide by all trading days, also those without a sale in that hour."""
    c = F.col
    return (
        star.fact_order_items.groupBy("time_key")
        .agg(*_sales(), count_distinct("order_id").alias("orders"))
        .join(star.dim_time, "time_key")
        .select(
            "hour_24", "hour_label", "day_part", "is_peak_window", "revenue", "items_sold",
            "orders",
            ratio(c("orders"), trading_days(star.fact_order_items), 1).alias("avg_orders_per_day"),
        )
    )


def weekday_hour_heatmap(star: Star) -> DataFrame:
    """Orders per occurrence: the days that had a sale in that weekday and hour."""
    days = star.dim_date.select("date_key", "day_of_week", "day_short")
    hours = star.dim_time.select("time_key", "hour_24", "hour_label")
    cell = ["day_of_week", "day_short", "hour_24", "hour_label"]
    # One row per order and cell of a day, so that the two distinct counts below copy few rows.
    baskets = star.fact_order_items.groupBy("date_key", "time_key", "order_id").agg(
        sum_money(F.col("total_price")).alias("revenue")
    )
    c = F.col
    return (
        baskets.join(days, "date_key")
        .join(hours, "time_key")
        .groupBy(*cell)
        .agg(
            count_distinct("order_id").alias("orders"),
            money(F.sum("revenue")).alias("revenue"),
            count_distinct("date_key").alias("days"),
        )
        .select(
            *cell, "orders", "revenue",
            ratio(c("orders"), c("days"), 1).alias("avg_orders_per_occurrence"),
        )
    )


def per_product(fact: DataFrame, star: Star) -> DataFrame:
    sums = (
        per_item(fact)
        .join(star.dim_item, "item_key")
        .groupBy("product_code")
        .agg(
            F.min("item_short_name").alias("item_short_name"),
            F.min("item_name").alias("item_name"),
            F.min("item_category").alias("item_category"),
            F.bool_or("is_vegetarian").alias("is_vegetarian"),
            money(F.sum("revenue")).alias("revenue"),
            F.sum("items_sold").alias("items_sold"),
            ratio(F.sum("price_sum"), F.sum("lines"), 2).alias("avg_unit_price"),
        )
    )
    orders = (
        fact.select("order_id", "item_key")
        .join(star.items("item_key", "product_code"), "item_key")
        .groupBy("product_code")
        .agg(count_distinct("order_id").alias("orders"))
    )
    return sums.join(orders, "product_code")


def pareto(products: DataFrame, revenue: Column, rows: int, limit: int) -> DataFrame:
    by_revenue = rank_from_top(
        products, "revenue", ["product_code"], rows,
        rank="revenue_rank", running={"running": "revenue"}, limit=limit,
    )
    by_volume = rank_from_top(
        by_revenue, "items_sold", ["product_code"], rows, rank="volume_rank", limit=limit
    )
    cumulative = percent(F.col("running"), revenue)
    return by_volume.select(
        "product_code", "item_short_name", "item_name", "item_category", "is_vegetarian",
        "revenue", "items_sold", "orders", "avg_unit_price", "revenue_rank", "volume_rank",
        percent(F.col("revenue"), revenue).alias("pct_of_revenue"),
        cumulative.alias("cumulative_pct_of_revenue"),
    ).withColumn("abc_class", abc_class(F.col("cumulative_pct_of_revenue")))


def product_performance(star: Star, limit: int = ONE_TASK_ROWS) -> DataFrame:
    products = per_product(star.fact_order_items, star)
    revenue = total_of(star.fact_order_items, "total_price")
    return pareto(products, revenue, star.item_rows, limit)


def per_order(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_id").agg(
        F.min("order_item_count").alias("items"), F.min("order_total_value").alias("order_value")
    )


def basket_profile(star: Star) -> DataFrame:
    baskets = per_order(star.fact_order_items).groupBy("items").agg(
        F.count("*").alias("orders"), sum_money(F.col("order_value")).alias("revenue")
    )
    everyone = star.fact_order_items.agg(count_distinct("order_id").alias("n")).scalar()
    c = F.col
    return baskets.select(
        c("items").alias("items_in_order"),
        "orders",
        percent(c("orders"), everyone).alias("pct_of_orders"),
        "revenue",
        ratio(c("revenue"), c("orders"), 2).alias("avg_order_value"),
    )


def product_affinity(star: Star, min_orders: int = 30) -> DataFrame:
    baskets = star.fact_order_items.select("order_id", "item_key").join(
        star.items("item_key", "product_code"), "item_key"
    )
    orders = star.fact_order_items.select("order_id").distinct().agg(F.count("*").alias("n"))
    names = star.dim_item.groupBy("product_code").agg(F.min("item_short_name").alias("name"))
    pairs = basket_affinity(
        baskets, "order_id", "product_code", orders.scalar(), star.item_rows, min_orders
    )
    names_a = names.select(F.col("product_code").alias("a"), F.col("name").alias("product_a"))
    names_b = names.select(F.col("product_code").alias("b"), F.col("name").alias("product_b"))
    return (
        pairs.join(names_a, "a")
        .join(names_b, "b")
        .select(
            "product_a", "product_b", "orders_together", "support_pct",
            "confidence_a_to_b_pct", "confidence_b_to_a_pct", "lift",
        )
    )


def ingredient_exposure(star: Star) -> DataFrame:
    """Revenue counts once per ingredient, so it adds up to more than the total by design."""
    sold = per_item(star.fact_order_items).join(
        star.dim_item.select("item_key", "product_code"), "item_key"
    )
    c = F.col
    return (
        sold.join(star.bridge_item_ingredient, "item_key")
        .groupBy("ingredient_key")
        .agg(
            count_distinct("product_code").alias("products_using"),
            F.sum("items_sold").alias("items_sold"),
            money(F.sum("revenue")).alias("attributed_revenue"),
        )
        .join(star.dim_ingredient, "ingredient_key")
        .select(
            "ingredient_name", "is_cheese", "products_using", "items_sold", "attributed_revenue",
            percent(
                c("attributed_revenue"), total_of(star.fact_order_items, "total_price")
            ).alias("pct_of_revenue"),
        )
    )


VIEWS = {
    "vw_fact_enriched": fact_enriched,
    "vw_kpi_headline": kpi_headline,
    "vw_daily_sales": daily_sales,
    "vw_monthly_trend": monthly_trend,
    "vw_sales_by_category": sales_by_category,
    "vw_sales_by_size": sales_by_size,
    "vw_hourly_demand": hourly_demand,
    "vw_weekday_hour_heatmap": weekday_hour_heatmap,
    "vw_product_performance": product_performance,
    "vw_basket_profile": basket_profile,
    "vw_product_affinity": product_affinity,
    "vw_ingredient_exposure": ingredient_exposure,
}

# The views that BI extracts are made of.
EXPORTED = [
    "vw_fact_enriched", "vw_product_performance", "vw_product_affinity", "vw_basket_profile",
    "vw_hourly_demand", "vw_monthly_trend", "vw_weekday_hour_heatmap", "vw_ingredient_exposure",
]
