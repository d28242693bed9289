"""The numbers behind the insight memo, each as a small frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.money import money, percent, ratio
from tillstar.plans import views
from tillstar.plans.star import Star
from tillstar.schemas import PEAK_DAY_PARTS


def year_metrics(star: Star) -> DataFrame:
    """Best and worst month, largest monthly swing, days without a sale."""
    month_no = F.datediff("month_start", F.lit("1970-01-01").cast("date"))
    months = views.monthly_trend(star)
    early = F.struct("revenue", -month_no)
    late = F.struct("revenue", month_no)
    days = star.dim_date.agg(F.count("*").alias("n")).scalar()
    return (
        months.agg(
            F.max_by("year_month", early).alias("best_month"),
            F.max("revenue").alias("best_month_revenue"),
            F.min_by("year_month", late).alias("worst_month"),
            F.min("revenue").alias("worst_month_revenue"),
            F.max(F.abs("mom_growth_pct")).alias("max_abs_mom_pct"),
        )
        .withColumn("calendar_days", days)
        .withColumn("trading_days", views.trading_days(star.fact_order_items))
        .withColumn("zero_sales_days", F.col("calendar_days") - F.col("trading_days"))
    )


def busiest_hours(star: Star) -> DataFrame:
    """Busiest hour (first of equals, and all of them), its orders, the peak windows' share."""
    hours = views.hourly_demand(star)
    top = F.struct("orders", -F.col("hour_24"))
    most = hours.agg(F.max("orders").alias("m")).scalar()
    ties = F.sort_array(F.collect_list(F.when(F.col("orders") == most, F.col("hour_label"))))
    in_peak = F.sum(F.when(F.col("day_part").isin(*PEAK_DAY_PARTS), F.col("orders")).otherwise(0))
    return hours.agg(
        F.max_by("hour_label", top).alias("busiest_hour"),
        F.max("orders").alias("peak_hour_orders"),
        F.concat_ws(",", ties).alias("busiest_hours"),
        percent(in_peak, F.sum("orders"), 1).alias("lunch_dinner_pct"),
    )


def hours_against_average(star: Star) -> DataFrame:
    """Orders per hour with the mean line, and a flag for the top fifth of hours."""
    hours = views.hourly_demand(star).select("hour_24", "hour_label", "orders")
    # At most 24 rows, so plain aggregates serve as subqueries.
    mean = hours.agg(ratio(F.sum("orders"), F.count("*"), 2).alias("m")).scalar()
    edge = hours.agg(F.percentile("orders", F.lit(0.8)).alias("q")).scalar()
    return hours.select(
        "hour_24", "hour_label", "orders",
        mean.alias("avg_orders"),
        (F.col("orders") > mean).alias("above_average"),
        (F.col("orders").cast("double") >= edge).alias("top_quintile"),
    )


def weekday_revenue(star: Star) -> DataFrame:
    daily = views.daily_sales(star)
    return daily.groupBy("day_name").agg(
        ratio(F.sum("revenue"), F.count("*"), 2).alias("avg_revenue")
    )


def weekday_gap(star: Star) -> DataFrame:
    """Strongest and weakest weekday by mean daily revenue, and the gap between them."""
    days = weekday_revenue(star)
    c = F.col
    key = F.struct("avg_revenue", "day_name")
    return days.agg(
        F.max_by("day_name", key).alias("best_day"),
        F.max("avg_revenue").alias("best_avg_revenue"),
        F.min_by("day_name", key).alias("worst_day"),
        F.min("avg_revenue").alias("worst_avg_revenue"),
    ).withColumn(
        "gap_pct",
        percent(c("best_avg_revenue") - c("worst_avg_revenue"), c("worst_avg_revenue"), 0),
    )


def abc_summary(star: Star) -> DataFrame:
    products = views.product_performance(star)
    top = F.struct("revenue", "product_code")
    is_a, is_c = F.col("abc_class") == "A", F.col("abc_class") == "C"
    share = F.when(is_c, F.col("pct_of_revenue")).otherwise(F.lit(0).cast("decimal(18,2)"))
    return products.agg(
        F.count("*").alias("products"),
        F.count_if(is_a).alias("a_products"),
        F.count_if(is_c).alias("c_products"),
        money(F.sum(share)).alias("c_pct_of_revenue"),
        F.max_by("product_code", top).alias("top_product"),
        F.max_by("pct_of_revenue", top).alias("top_pct"),
        F.min_by("product_code", top).alias("bottom_product"),
        F.min_by("pct_of_revenue", top).alias("bottom_pct"),
    )


def mix_summary(star: Star) -> DataFrame:
    categories = views.sales_by_category(star).agg(
        (F.max("pct_of_revenue") - F.min("pct_of_revenue")).cast("decimal(18,2)").alias(
            "category_spread_points"
        ),
        F.max_by("item_category", F.struct("revenue", "item_category")).alias("top_category"),
        F.max("pct_of_revenue").alias("top_category_pct"),
    )
    sizes = views.sales_by_size(star)
    best = F.struct("revenue", "item_size")
    return categories.withColumn(
        "top_size", sizes.agg(F.max_by("item_size", best).alias("s")).scalar()
    ).withColumn("top_size_pct", sizes.agg(F.max("pct_of_revenue").alias("p")).scalar())


def basket_summary(star: Star) -> DataFrame:
    baskets = views.basket_profile(star)
    single = F.when(F.col("items_in_order") == 1, F.col("pct_of_orders"))
    return baskets.agg(
        F.coalesce(F.max(single), F.lit(0).cast("decimal(18,2)")).alias("single_item_pct"),
        ratio(F.sum("revenue"), F.sum("orders"), 2).alias("avg_order_value"),
        ratio(F.sum(F.col("items_in_order") * F.col("orders")), F.sum("orders"), 2).alias(
            "avg_items_per_order"
        ),
    )
