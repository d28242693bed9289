"""The analyst's query library: thirteen stakeholder questions on top of the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.money import amount, money, percent, ratio
from tillstar.plans import views
from tillstar.plans.star import Star


def headline(star: Star) -> DataFrame:
    return views.kpi_headline(star)


def monthly(star: Star) -> DataFrame:
    return views.monthly_trend(star).orderBy("month_start").select(
        "year_month", "revenue", "prev_month_revenue", "mom_growth_pct", "pct_of_year_revenue"
    )


def weekday_pattern(star: Star) -> DataFrame:
    """Averages divide by the traded days of that weekday."""
    days = star.dim_date.select("date_key", "day_name", "day_of_week")
    baskets = (
        star.fact_order_items.groupBy("date_key", "order_id")
        .agg(views._sales()[0])
        .join(days, "date_key")
    )
    c = F.col
    return (
        baskets.groupBy("day_name", "day_of_week")
        .agg(
            F.countDistinct("date_key").alias("days_traded"),
            money(F.sum("revenue")).alias("revenue"),
            F.countDistinct("order_id").alias("orders"),
        )
        .select(
            "day_name", "day_of_week", "days_traded", "revenue",
            ratio(c("revenue"), c("days_traded"), 2).alias("avg_revenue_per_day"),
            ratio(c("orders"), c("days_traded"), 1).alias("avg_orders_per_day"),
        )
        .orderBy("day_of_week")
    )


def day_part_share(star: Star) -> DataFrame:
    """Orders are added up over hours, as shown per hour."""
    hours = views.hourly_demand(star)
    whole = hours.agg(F.sum("orders").alias("n")).scalar()
    return (
        hours.groupBy("day_part")
        .agg(F.sum("orders").alias("orders"), money(F.sum("revenue")).alias("revenue"))
        .select("day_part", "orders", percent(F.col("orders"), whole).alias("pct_of_orders"),
                "revenue")
        .orderBy(F.col("orders").desc(), "day_part")
    )


def pareto_list(star: Star) -> DataFrame:
    return views.product_performance(star).select(
        "revenue_rank", "item_short_name", "item_category", "revenue", "pct_of_revenue",
        "cumulative_pct_of_revenue", "abc_class",
    ).orderBy("revenue_rank", "item_short_name")


def delist_candidates(star: Star) -> DataFrame:
    return (
        views.product_performance(star)
        .filter(F.col("abc_class") == "C")
        .select("item_short_name", "item_category", "items_sold", "revenue", "pct_of_revenue")
        .orderBy("revenue", "item_short_name")
    )


def levers(star: Star) -> DataFrame:
    size = views.sales_by_size(star).select(
        F.lit("size").alias("lever"), F.col("item_size").alias("value"), "pct_of_revenue"
    )
    category = views.sales_by_category(star).select(
        F.lit("category").alias("lever"), F.col("item_category").alias("value"), "pct_of_revenue"
    )
    return size.unionByName(category).orderBy(
        "lever", F.col("pct_of_revenue").desc(), "value"
    )


def cross_sell(star: Star, min_lift: float = 1, top: int = 20) -> DataFrame:
    return (
        views.product_affinity(star)
        .filter(F.col("lift") > min_lift)
        .orderBy(F.col("lift").desc(), F.col("orders_together").desc(), "product_a", "product_b")
        .limit(top)
        .select("product_a", "product_b", "orders_together", "support_pct",
                "confidence_a_to_b_pct", "lift")
    )


def affinity_matrix(star: Star, min_lift: str = "1.2") -> DataFrame:
    return views.product_affinity(star).filter(
        F.col("lift") > F.lit(min_lift).cast("decimal(18,3)")
    ).select("product_a", "product_b", "lift")


def basket_distribution(star: Star) -> DataFrame:
    return views.basket_profile(star).orderBy("items_in_order")


def top_ingredients(star: Star, top: int = 20) -> DataFrame:
    return (
        views.ingredient_exposure(star)
        .orderBy(F.col("attributed_revenue").desc(), "ingredient_name")
        .limit(top)
        .select("ingredient_name", "products_using", "items_sold", "attributed_revenue",
                "pct_of_revenue")
    )


def best_and_worst_days(star: Star, top: int = 5) -> DataFrame:
    days = views.daily_sales(star).select("full_date", "day_name", "revenue", "orders")
    best = days.orderBy(F.col("revenue").desc(), "full_date").limit(top)
    worst = days.orderBy("revenue", "full_date").limit(top)
    return best.select(F.lit("best").alias("bucket"), "*").unionByName(
        worst.select(F.lit("worst").alias("bucket"), "*")
    )


def days_without_sales(star: Star) -> DataFrame:
    sold = star.fact_order_items.select("date_key").distinct()
    return (
        star.dim_date.join(sold, "date_key", "left_anti")
        .select("full_date", "day_name")
        .orderBy("full_date")
    )


def price_rule_breaks(star: Star) -> DataFrame:
    return star.fact_order_items.agg(
        F.count_if(amount(F.col("unit_price"), F.col("quantity")) != F.col("total_price")).alias(
            "rows_breaking_price_rule"
        )
    )
