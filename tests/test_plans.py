import re
from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.plans import cube, analyst, insights, measures, views
from tillstar.plans.measures import SliceSpec

D = Decimal


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


@pytest.fixture
def gaps(star):
    """Sales on days 1, 2 and 20 of January and in March."""
    return star(
        (1, "a", "2015-01-01 11:00:00", 1, 70), (2, "a", "2015-01-02 12:00:00", 1, 30),
        (3, "b", "2015-01-20 18:00:00", 2, 10), (4, "c", "2015-03-05 22:00:00", 1, 150),
    )


def test_row_and_calendar_averages_differ_over_gaps(gaps):
    rows = by(views.daily_sales(gaps), "full_date", "revenue_7d_moving_avg")
    calendar = by(measures.moving_avg_calendar(gaps), "full_date", "revenue_7d_calendar_avg")
    day = date(2015, 1, 20)
    assert rows[day] == D("40.00") and calendar[day] == D("20.00")
    assert calendar[date(2015, 1, 8)] == D("30.00") and calendar[date(2015, 1, 9)] is None


def test_lag_and_calendar_month_differ_over_gaps(gaps):
    lag = by(views.monthly_trend(gaps), "year_month", "mom_growth_pct")
    month = by(measures.mom_calendar(gaps), "year_month", "mom_growth_pct")
    assert lag == {"2015-01": None, "2015-03": D("25.00")}
    assert month == {"2015-01": None, "2015-03": None}


def test_days_without_sales(gaps):
    days = [r.full_date for r in analyst.days_without_sales(gaps).collect()]
    assert len(days) == 64 - 4 and days[0] == date(2015, 1, 3)
    year = insights.year_metrics(gaps).first()
    assert (year.best_month, year.zero_sales_days, year.max_abs_mom_pct) == ("2015-03", 60, D("25.00"))


def test_year_to_date_runs_over_the_calendar(gaps):
    ytd = by(measures.ytd_revenue(gaps), "full_date", "revenue_ytd")
    assert ytd[date(2015, 2, 1)] == D("120.00") and ytd[date(2015, 3, 5)] == D("270.00")


def test_denominators_per_day(gaps):
    hours = by(views.hourly_demand(gaps), "hour_24", "avg_orders_per_day")
    assert hours[11] == D("0.3")  # one order over four trading days
    cells = by(views.weekday_hour_heatmap(gaps), "hour_24", "avg_orders_per_occurrence")
    assert cells[11] == D("1.0")


def test_ties_in_rank_and_running_share(star):
    s = star(*[(i, c, "2015-01-01 11:00:00", 1, v)
               for i, (c, v) in enumerate([("a", 50), ("b", 30), ("c", 30), ("d", 10)])])
    perf = {r.product_code: r for r in views.product_performance(s).collect()}
    assert [perf[c].revenue_rank for c in "abcd"] == [1, 2, 2, 4]
    assert [perf[c].cumulative_pct_of_revenue for c in "abcd"] == [
        D("41.67"), D("66.67"), D("91.67"), D("100.00")]
    assert [perf[c].abc_class for c in "abcd"] == ["A", "A", "B", "C"]
    dense = {r.product_code: r for r in measures.pareto_dense(s).collect()}
    assert [dense[c].revenue_rank for c in "abcd"] == [1, 2, 2, 3]
    assert [dense[c].pareto_pct for c in "abcd"] == [
        D("41.67"), D("91.67"), D("91.67"), D("100.00")]
    assert {r.product_code for r in measures.top_n_products(s, 2).collect()} == {"a", "b", "c"}
    ranged = views.product_performance(s, limit=2)
    assert sorted(map(str, ranged.collect())) == sorted(map(str, perf.values()))


def test_abc_borders(star):
    s = star(*[(i, c, "2015-01-01 11:00:00", 1, v)
               for i, (c, v) in enumerate([("a", 80), ("b", 15), ("c", 5)])])
    assert by(views.product_performance(s), "product_code", "abc_class") == {
        "a": "A", "b": "B", "c": "C"}
    assert by(measures.pareto_bands(s), "product_code", "band") == {
        "a": "A - top 80% of revenue", "b": "B - next 15%", "c": "C - tail"}


def test_affinity_of_small_baskets(star):
    rows = []
    for order in range(40):
        rows.append((order, "a", "2015-01-01 11:00:00", 1, 5))
        if order < 30:
            rows.append((order, "b", "2015-01-01 11:00:00", 1, 5))
        if order % 2:
            rows.append((order, "c", "2015-01-01 11:00:00", 1, 5))
    got = views.product_affinity(star(*rows)).collect()
    assert [tuple(r) for r in got] == [
        ("A", "B", 30, D("75.000"), D("75.00"), D("100.00"), D("1.000"))]


def test_totals_agree_across_views(gaps):
    total = views.kpi_headline(gaps).first().total_revenue
    for frame, column in (
        (views.sales_by_category(gaps), "revenue"), (views.sales_by_size(gaps), "revenue"),
        (views.hourly_demand(gaps), "revenue"), (views.basket_profile(gaps), "revenue"),
        (views.product_performance(gaps), "revenue"),
    ):
        assert sum(r[column] for r in frame.collect()) == total == D("270.00")
    shares = [r.pct_of_revenue for r in views.product_performance(gaps).collect()]
    assert abs(sum(shares) - 100) <= D("0.03")


def test_baskets(gaps):
    baskets = by(views.basket_profile(gaps), "items_in_order", "orders")
    assert baskets == {1: 3, 2: 1}
    kinds = by(measures.basket_lod(gaps), "order_kind", "avg_basket_value")
    assert kinds == {"Single item": D("83.33"), "Multi-item": D("20.00")}


def test_slices_and_measures(gaps):
    january = SliceSpec(months=("2015-01",), day_parts=("Lunch", "Dinner"))
    got = measures.sliced(gaps, january).first()
    assert (got.revenue, got.orders, got.items_sold, got.avg_unit_price) == (
        D("120.00"), 3, 4, D("30.00"))
    assert measures.sliced(
        gaps, SliceSpec(date_from="2015-01-02", date_to="2015-01-20")
    ).first().revenue == D("50.00")
    assert measures.selected_metric(gaps, "Orders", ["item_category"]).first().value == D("4.00")
    with pytest.raises(ValueError, match="unknown measures"):
        measures.measure(gaps.fact_order_items, ["profit"])


def test_peak_hours(gaps):
    hours = insights.busiest_hours(gaps).first()
    assert (hours.busiest_hour, hours.busiest_hours) == ("11:00", "11:00,12:00,18:00,22:00")
    assert hours.lunch_dinner_pct == D("75.0")
    assert measures.peak_window_share(gaps).first().peak_window_pct == D("75.00")


def test_best_and_worst_days(gaps):
    rows = analyst.best_and_worst_days(gaps, top=1).collect()
    assert [(r.bucket, r.full_date) for r in rows] == [
        ("best", date(2015, 3, 5)), ("worst", date(2015, 1, 20))]


# --- physical plans --------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_scale(gaps):
    for view in (views.kpi_headline, views.daily_sales, views.product_performance,
                 views.product_affinity, views.ingredient_exposure, views.basket_profile):
        text = plan(view(gaps))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, view
        assert "order_ts" not in text, view  # columns that a view does not use are not read


def test_filters_reach_the_scan(gaps):
    where = SliceSpec(date_from="2015-01-02", date_to="2015-01-20", sizes=("M",))
    text = plan(measures.sliced(gaps, where, ["revenue"]))
    assert "GreaterThanOrEqual(date_key,20150102)" in text
    assert "EqualTo(item_size,M)" in text or "In(item_size" in text


def test_repeats_are_cut_before_the_shuffle(spark, raw):
    from tillstar.operators.quarantine import clean_lines

    assert plan(clean_lines(raw({}))).count("WindowGroupLimit") == 4


# --- the summary that slices are asked of ---


@pytest.fixture(scope="module")
def many(spark, star, tmp_path_factory):
    rows = []
    for i in range(160):
        day = date(2015, 1, 1 + (i * 7) % 28).replace(month=1 + i % 5)
        rows.append((i % 45, "abc"[i % 3], f"{day} {(i * 5) % 24:02d}:00:00", 1 + i % 3, 10 + i % 4))
    built, folder = star(*rows), str(tmp_path_factory.mktemp("cube"))
    return cube.build_cube(
        built, lambda df, name, by: cube.partitioned(df, f"{folder}/{name}", by), one_task_rows=10
    )


@pytest.mark.parametrize("where", [
    SliceSpec(), SliceSpec(months=("2015-02", "2015-04")), SliceSpec(date_from="2015-02-01"),
    SliceSpec(date_from="2015-01-09", date_to="2015-04-11"), SliceSpec(date_to="2015-03-31"),
    SliceSpec(date_from="2015-02-05", date_to="2015-02-20"), SliceSpec(date_from="2015-03-01", date_to="2015-02-01"),
    SliceSpec(date_from="2015-02-10", date_to="2015-03-09", day_parts=("Lunch",), months=("2015-02",)),
    SliceSpec(date_from="2015-01-31", date_to="2015-02-28", sizes=("M",)), SliceSpec(categories=("None",)),
])
@pytest.mark.parametrize("by", [[], ["day_part"], ["year_month", "item_category"]])
def test_slices_of_the_summary_are_those_of_the_lines(many, where, by):
    names = measures.MEASURES
    want = measures.sliced(many.star, where, names, by).collect()
    assert sorted(map(str, cube.sliced(many, where, names, by).collect())) == sorted(map(str, want))


def test_whole_months_do_not_read_lines(many):
    text = plan(cube.sliced(many, SliceSpec(date_from="2015-02-01", date_to="2015-03-31"), by=["item_size"]))
    assert "order_item_id" not in text and "total_price" not in text and "fact_order_items" not in text
    assert "PartitionFilters: [isnotnull(year_month" in text and "year_month#" in text
    with pytest.raises(ValueError, match="unknown"):
        cube.sliced(many, by=["order_id"])


def test_order_bitmaps_are_made_whole_and_without_lines(many, tmp_path):
    plans = {}

    def stage(df, name, by):
        plans[name] = plan(df)
        return cube.partitioned(df, str(tmp_path / name), by)

    cube.build_cube(many.star, stage, one_task_rows=10)
    assert "order_no" not in plans["sums"]  # sums need no numbers of orders
    assert "order_id" not in plans["orders"] and "SortMergeJoin" not in plans["orders"]
    # 45 orders, 10 to a task; a bitmap's orders meet before it is made, so no part of it moves
    assert re.findall(r"Exchange hashpartitioning\((.*?)#.*?, (\d+)\)", plans["orders"]) == [("bucket", "5")]


def test_an_order_of_most_lines_and_lines_without_order(star, tmp_path, monkeypatch):
    monkeypatch.setattr(cube, "TASK_LINES", 7)
    rows = [
        (1 if i % 4 else i, "abc"[i % 3], f"2015-0{1 + i % 2}-{1 + i % 28:02d} {i % 24:02d}:00:00", 1 + i, 10)
        for i in range(60)
    ]
    built = star(*rows)
    fact = built.fact_order_items
    lost = fact.withColumn("order_id", F.when(F.col("order_id") != 8, F.col("order_id")))
    summary = cube.build_cube(
        replace(built, fact_order_items=lost),
        lambda df, name, by: cube.partitioned(df, str(tmp_path / name), by), one_task_rows=3,
    )
    kept = replace(built, fact_order_items=fact.filter("order_id != 8"))
    for where in (SliceSpec(), SliceSpec(date_from="2015-01-03", date_to="2015-02-17")):
        for by in ([], ["item_category", "day_part"]):
            want = measures.sliced(kept, where, measures.MEASURES, by).collect()
            got = cube.sliced(summary, where, measures.MEASURES, by).collect()
            assert sorted(map(str, got)) == sorted(map(str, want))
