"""BI measures that can be asked for by any grouping and under any filter."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.bands import abc_right_closed, pareto_band, trust_label
from tillstar.functions.money import growth, money, percent, ratio, sum_money
from tillstar.operators.ordered import ONE_TASK_ROWS, exact_quantiles, rank_from_top
from tillstar.plans import views
from tillstar.plans.star import Star, enriched
from tillstar.schemas import PEAK_DAY_PARTS


@dataclass(frozen=True)
class SliceSpec:
    """Report slicers. An empty field does not filter."""

    months: tuple[str, ...] = ()
    date_from: str | None = None
    date_to: str | None = None
    categories: tuple[str, ...] = ()
    sizes: tuple[str, ...] = ()
    day_parts: tuple[str, ...] = ()

    def apply(self, lines: DataFrame) -> DataFrame:
        """Filter lines that carry the dimension attributes."""
        for column, wanted in (
            ("year_month", self.months),
            ("item_category", self.categories),
            ("item_size", self.sizes),
            ("day_part", self.day_parts),
        ):
            if wanted:
                lines = lines.filter(F.col(column).isin(*wanted))
        # Bounds on the key column of the fact itself, so they reach its scan.
        if self.date_from:
            lines = lines.filter(F.col("date_key") >= int(self.date_from.replace("-", "")))
        if self.date_to:
            lines = lines.filter(F.col("date_key") <= int(self.date_to.replace("-", "")))
        return lines


def _base() -> dict[str, Column]:
    return {
        "revenue": sum_money(F.col("total_price")),
        "items_sold": F.sum("quantity"),
        "orders": F.countDistinct("order_id"),
        "trading_days": F.countDistinct("date_key"),
    }


# Ratios: numerator, denominator, digits.
RATIOS = {
    "avg_order_value": ("revenue", "orders", 2),
    "items_per_order": ("items_sold", "orders", 2),
    "avg_unit_price": ("revenue", "items_sold", 2),
    "revenue_per_day": ("revenue", "trading_days", 2),
    "orders_per_day": ("orders", "trading_days", 2),
}

MEASURES = ["revenue", "items_sold", "orders", "trading_days", *RATIOS]

# Display names of the metric switch.
METRIC_NAMES = {
    "Revenue": "revenue",
    "Orders": "orders",
    "Items Sold": "items_sold",
    "Average Order Value": "avg_order_value",
}


def measure(lines: DataFrame, names: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    """The named measures per group; only the sums and distinct counts they need are taken."""
    names, by = list(names), list(by)
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures: {unknown}")
    base = _base()
    needed = [b for b in base if b in names or any(b in RATIOS.get(n, ())[:2] for n in names)]
    if {"orders", "trading_days"} <= set(needed):
        # Two distinct counts copy each row, so lines are summed up to orders of a day first.
        sums = {"revenue": "_money", "items_sold": "_units"}
        kept = {b: c for b, c in sums.items() if b in needed}
        lines = lines.groupBy(*by, "date_key", "order_id").agg(
            *[base[b].alias(c) for b, c in kept.items()]
        )
        base |= {b: F.sum(c) for b, c in kept.items()}
        if "revenue" in kept:
            base["revenue"] = money(base["revenue"])
    grouped = lines.groupBy(*by).agg(*[base[b].alias(b) for b in needed])
    out = [
        ratio(F.col(RATIOS[n][0]), F.col(RATIOS[n][1]), RATIOS[n][2]).alias(n)
        if n in RATIOS
        else F.col(n)
        for n in names
    ]
    return grouped.select(*by, *out)


def sliced(
    star: Star, where: SliceSpec, names: Iterable[str] = MEASURES, by: Iterable[str] = ()
) -> DataFrame:
    return measure(where.apply(enriched(star)), names, by)


def selected_metric(star: Star, metric: str, by: Iterable[str]) -> DataFrame:
    """The metric chosen by its display name, under one column name whatever it is."""
    name = METRIC_NAMES[metric]
    return measure(enriched(star), [name], by).select(
        *by, F.lit(metric).alias("metric"), F.col(name).cast("decimal(18,2)").alias("value")
    )


# --- time ------------------------------------------------------------------------------------


def mom_calendar(star: Star) -> DataFrame:
    """Growth against the calendar month before; NULL if that month had no sales."""
    month = views.per_month(star).withColumn(
        "month_first", F.trunc("month_start", "month")
    ).select("year_month", "month_first", "revenue")
    before = month.select(
        F.add_months("month_first", 1).alias("month_first"), F.col("revenue").alias("revenue_pm")
    )
    c = F.col
    return month.join(before, "month_first", "left").select(
        "year_month", "revenue", "revenue_pm",
        growth(c("revenue"), c("revenue_pm")).alias("mom_growth_pct"),
    )


def mom_against_last_row(star: Star) -> DataFrame:
    """Growth against the month row before, over its absolute value; missing values count 0."""
    month = views.per_month(star)
    revenue = F.coalesce(F.col("revenue"), F.lit(0).cast("decimal(18,2)"))
    previous = F.lag(revenue).over(Window.orderBy("month_start"))
    return month.select(
        "year_month", "revenue", percent(revenue - previous, F.abs(previous)).alias("mom_pct")
    )


def _calendar_revenue(star: Star) -> DataFrame:
    """Revenue of every calendar day; NULL on days without sales."""
    daily = star.fact_order_items.groupBy("date_key").agg(
        sum_money(F.col("total_price")).alias("revenue")
    )
    return star.dim_date.join(daily, "date_key", "left")


def ytd_revenue(star: Star) -> DataFrame:
    year = Window.partitionBy("year").orderBy("full_date")
    return _calendar_revenue(star).select(
        "full_date",
        money(F.coalesce("revenue", F.lit(0))).alias("revenue"),
        money(F.coalesce(F.sum("revenue").over(year), F.lit(0))).alias("revenue_ytd"),
    )


def moving_avg_calendar(star: Star) -> DataFrame:
    """Mean over the last seven calendar days, of the days that had revenue."""
    week = Window.orderBy(F.datediff("full_date", F.lit("1970-01-01").cast("date"))).rangeBetween(
        -6, Window.currentRow
    )
    return _calendar_revenue(star).select(
        "full_date",
        "revenue",
        ratio(F.sum("revenue").over(week), F.count("revenue").over(week), 2).alias(
            "revenue_7d_calendar_avg"
        ),
    )


# --- contribution and ranking ----------------------------------------------------------------


def share_of_selected(star: Star, where: SliceSpec, by: str) -> DataFrame:
    lines = where.apply(enriched(star))
    whole = lines.agg(F.sum("total_price").alias("t")).scalar()
    return measure(lines, ["revenue"], [by]).withColumn(
        "pct_of_selected", percent(F.col("revenue"), whole)
    )


def _product_revenue(star: Star) -> DataFrame:
    return (
        views.per_item(star.fact_order_items)
        .join(star.dim_item, "item_key")
        .groupBy("product_code")
        .agg(
            F.min("item_category").alias("item_category"),
            money(F.sum("revenue")).alias("revenue"),
            F.sum("items_sold").alias("items_sold"),
        )
    )


def pareto_dense(star: Star, limit: int = ONE_TASK_ROWS) -> DataFrame:
    """Dense rank; the running total includes all products of equal revenue."""
    total = views.total_of(star.fact_order_items, "total_price")
    ranked = rank_from_top(
        _product_revenue(star), "revenue", ["product_code"], star.item_rows,
        dense_rank="revenue_rank", running_with_ties="running", limit=limit,
    )
    return ranked.select(
        "product_code", "revenue", "revenue_rank",
        money(F.col("running")).alias("revenue_running_total"),
        percent(F.col("running"), total).alias("pareto_pct"),
    )


def pareto_bands(star: Star, limit: int = ONE_TASK_ROWS) -> DataFrame:
    total = views.total_of(star.fact_order_items, "total_price")
    ranked = rank_from_top(
        _product_revenue(star), "revenue", ["product_code"], star.item_rows,
        running={"running": "revenue"}, limit=limit,
    )
    return ranked.select(
        "product_code", "revenue", pareto_band(F.col("running"), total).alias("band")
    )


def pareto_of_rounded_shares(star: Star, limit: int = ONE_TASK_ROWS) -> DataFrame:
    """The offline variant: row-number rank, running sum of rounded shares, right-closed bins."""
    total = views.total_of(star.fact_order_items, "total_price")
    shares = _product_revenue(star).withColumn("pct", percent(F.col("revenue"), total))
    ranked = rank_from_top(
        shares, "revenue", ["product_code"], star.item_rows,
        position="revenue_rank", running={"running": "pct"}, limit=limit,
    )
    running = money(F.col("running"))
    return ranked.select(
        "product_code", "revenue", "revenue_rank", F.col("pct").alias("pct_of_revenue"),
        running.alias("cumulative_pct_of_revenue"),
        abc_right_closed(running).alias("abc_class"),
    )


def top_n_products(star: Star, n: int = 10, limit: int = ONE_TASK_ROWS) -> DataFrame:
    """Products ranked n or better; ties at the border all stay."""
    return rank_from_top(
        _product_revenue(star), "revenue", ["product_code"], star.item_rows,
        rank="revenue_rank", limit=limit,
    ).filter(F.col("revenue_rank") <= n).select("product_code", "revenue", "revenue_rank")


def first_products(star: Star, n: int, best: bool = True) -> DataFrame:
    """The n products with the most, or least, revenue."""
    order = F.col("revenue").desc() if best else F.col("revenue").asc()
    return (
        _product_revenue(star)
        .orderBy(order, "product_code")
        .limit(n)
        .select("product_code", "item_category", "revenue", "items_sold")
    )


def price_vs_volume(star: Star) -> DataFrame:
    """Volume against the average price weighted by units."""
    c = F.col
    return _product_revenue(star).select(
        "product_code", "item_category", "items_sold",
        ratio(c("revenue"), c("items_sold"), 2).alias("avg_unit_price"), "revenue",
    )


def menu_quadrant(star: Star, limit: int = ONE_TASK_ROWS) -> DataFrame:
    """Products above or below the median volume and the median list price."""
    price = star.dim_item.groupBy("product_code").agg(
        ratio(F.sum("unit_price"), F.count("*"), 2).alias("list_price")
    )
    points = _product_revenue(star).join(price, "product_code")
    volume_mid = exact_quantiles(points, "items_sold", [0.5], limit).scalar()
    price_mid = exact_quantiles(points, "list_price", [0.5], limit).scalar()
    busy = F.col("items_sold") >= volume_mid
    dear = F.col("list_price").cast("double") >= price_mid
    return points.select(
        "product_code", "items_sold", "list_price", "revenue",
        F.when(busy & dear, "star")
        .when(busy, "volume driver")
        .when(dear, "margin driver")
        .otherwise("delist candidate")
        .alias("quadrant"),
    )


def pareto_by_day_part(star: Star, day_part: str, limit: int = ONE_TASK_ROWS) -> DataFrame:
    """What sells in one part of the day: the product view of those lines only."""
    hours = star.dim_time.filter(F.col("day_part") == day_part).select("time_key")
    fact = star.fact_order_items.join(hours, "time_key", "left_semi")
    products = views.per_product(fact, star)
    revenue = views.total_of(fact, "total_price")
    return views.pareto(products, revenue, star.item_rows, limit)


# --- demand ----------------------------------------------------------------------------------


def peak_window_share(star: Star) -> DataFrame:
    """Distinct orders with a line in a peak window, over all orders."""
    hours = star.fact_order_items.join(star.dim_time.select("time_key", "day_part"), "time_key")
    peak = F.max(F.col("day_part").isin(*PEAK_DAY_PARTS))
    return (
        hours.groupBy("order_id")
        .agg(peak.alias("peak"))
        .agg(F.count_if("peak").alias("peak_orders"), F.count("*").alias("orders"))
        .withColumn("peak_window_pct", percent(F.col("peak_orders"), F.col("orders")))
    )


def heatmap_pivot(star: Star) -> DataFrame:
    """Weekdays by hours, distinct orders in the cells."""
    lines = star.fact_order_items.join(
        star.dim_date.select("date_key", "day_of_week", "day_short"), "date_key"
    )
    cells = lines.groupBy("day_of_week", "day_short", "time_key").agg(
        F.countDistinct("order_id").alias("orders")
    )
    wide = cells.groupBy("day_of_week", "day_short").pivot("time_key", list(range(24))).agg(
        F.sum("orders")
    )
    return wide.select(
        "day_of_week", "day_short",
        *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h:02d}") for h in range(24)],
    )


# --- basket ----------------------------------------------------------------------------------


def attach_rate(star: Star) -> DataFrame:
    """Share of all orders that contain the product."""
    everyone = star.fact_order_items.agg(F.countDistinct("order_id").alias("n")).scalar()
    return views.orders_by(star, "product_code").withColumn(
        "attach_rate_pct", percent(F.col("orders"), everyone)
    )


def affinity_means(star: Star) -> DataFrame:
    pairs = views.product_affinity(star)
    n = F.count("*")
    lift = F.sum(F.col("lift") * 1000).cast("decimal(24,0)")
    return pairs.agg(
        n.alias("pairs"),
        (ratio(lift, n * 1000, 3)).alias("avg_lift"),
        ratio(F.sum("confidence_a_to_b_pct"), n, 2).alias("avg_confidence_pct"),
    )


def basket_lod(star: Star) -> DataFrame:
    """Baskets by kind, with the mean of their fixed per-order value."""
    baskets = star.fact_order_items.groupBy("order_id").agg(
        sum_money(F.col("total_price")).alias("basket_value"), F.sum("quantity").alias("units")
    )
    kind = F.when(F.col("units") > 1, "Multi-item").otherwise("Single item")
    return (
        baskets.groupBy(kind.alias("order_kind"))
        .agg(F.count("*").alias("orders"), money(F.sum("basket_value")).alias("revenue"))
        .withColumn("avg_basket_value", ratio(F.col("revenue"), F.col("orders"), 2))
    )


def ingredient_concentration(star: Star, min_pct: int = 25) -> DataFrame:
    return views.ingredient_exposure(star).agg(
        F.count_if(F.col("pct_of_revenue") > min_pct).alias("ingredients_above"),
        F.count("*").alias("ingredients"),
    )


# --- trust and hierarchies -------------------------------------------------------------------


def data_trust(star: Star) -> DataFrame:
    return star.fact_order_items.agg(
        F.count_if("price_variance_flag").alias("price_variance_rows")
    ).withColumn("data_trust_label", trust_label(F.col("price_variance_rows")))


def calendar_rollup(star: Star) -> DataFrame:
    """Year, quarter, month and day totals in one result; rolled up from daily sums."""
    days = (
        star.fact_order_items.groupBy("date_key")
        .agg(sum_money(F.col("total_price")).alias("revenue"), F.sum("quantity").alias("items_sold"))
        .join(star.dim_date, "date_key")
    )
    return days.rollup("year", "quarter_name", "year_month", "full_date").agg(
        F.grouping_id().cast("bigint").alias("level"),
        money(F.sum("revenue")).alias("revenue"),
        F.sum("items_sold").alias("items_sold"),
    )


def grouping_sets_mix(star: Star) -> DataFrame:
    """Category totals, size totals and the grand total in one pass over per-item sums."""
    items = views.per_item(star.fact_order_items).join(star.dim_item, "item_key")
    category, size = F.col("item_category"), F.col("item_size")
    return items.groupingSets([[category], [size], []], category, size).agg(
        money(F.sum("revenue")).alias("revenue"), F.sum("items_sold").alias("items_sold")
    )
