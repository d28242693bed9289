import os
import time
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators import dimensions as dim
from tillstar.operators import quality
from tillstar.operators.facts import require_no_orphans
from tillstar.operators.quarantine import SUMMARY, run_summary
from tillstar.plans import views
from tillstar.plans.star import build_star, register_views, star_from_csv, view
from tillstar.schemas import TABLES
from tillstar.sources import warehouse
from tillstar.sources.warehouse import staged

ROWS = [
    {"item_id": 1, "order_id": 1, "item_name_id": "GARDEN_M", "unit_price": "10.00",
     "total_price": "10.00"},
    {"item_id": 2, "order_id": 1, "item_name_id": "alpha_hen_l", "item_size": "L", "quantity": 2,
     "unit_price": "20.75", "total_price": "41.50", "item_category": "chicken",
     "item_name": "The Alpha Hen Dish", "item_ingredients": "Barbecued Chicken, sun-dried tomatoes"},
    {"item_id": 3, "order_id": 2, "item_name_id": "alpha_hen_s", "item_size": "S",
     "order_date": "04-01-2015", "unit_price": "12.75", "total_price": "12.80",
     "item_category": "chicken", "item_name": "The Alpha Hen Dish",
     "item_ingredients": "Barbecued Chicken, , Barbecued  Chicken,?NOVA salami"},
    {"item_id": 4, "order_id": 3, "item_name_id": "garden_m", "order_date": "04-01-2015",
     "unit_price": "10.01", "total_price": "10.01"},
]


def test_rejected_rows_stay_with_the_star(spark, write_csv, tmp_path):
    first = write_csv(tmp_path / "a.csv", [{**ROWS[0], "unit_price": "11.00"}])
    copies = [{**r, "item_id": 1} for r in ROWS] + [{"item_id": "x"}, {"item_id": 9, "quantity": 0}]
    second = write_csv(tmp_path / "b.csv", copies * 50)
    star = star_from_csv(spark, str(tmp_path / "*.csv"), str(tmp_path / "star"))
    assert first < second  # the copy of the first file is kept, however long the second one is
    assert [r.unit_price for r in star.fact_order_items.collect()] == [Decimal("11.00")]
    reasons = {r.reject_reason: r["count"] for r in
               star.rejected_rows.groupBy("reject_reason").count().collect()}
    assert reasons == {"duplicate item_id": 200, "unparseable identifier": 50,
                       "quantity must be a positive integer": 50}
    root = str(tmp_path / "warehouse")
    warehouse.publish(star.tables(), root)
    loaded = warehouse.read_published(spark, root)
    assert loaded["rejected_rows"].count() == 300
    status = {r.check: r.status for r in quality.quality_report(loaded).collect()}
    assert status["rejection rate below 1%"] == "WARN"
    with pytest.raises(ValueError):
        quality.quality_report({k: v for k, v in loaded.items() if k != "rejected_rows"})


def test_the_run_summary_is_counted_while_tables_are_written(spark, write_csv, tmp_path):
    path = write_csv(tmp_path / "raw.csv", [*ROWS, ROWS[0], {"item_id": "x"}, {"item_id": 9, "quantity": 0}])
    star = star_from_csv(spark, path, str(tmp_path / "star"))
    assert star.summary.collect() == run_summary(star.judged).collect() == [(7, 3, 4, 1)]
    assert star.summary.columns == SUMMARY
    assert "shared-order" not in os.listdir(tmp_path / "star")  # rows of files have a place of their own


@pytest.fixture
def dish_star(spark, write_csv, tmp_path):
    path = write_csv(tmp_path / "raw.csv", ROWS, noun="dish")
    return star_from_csv(spark, path, str(tmp_path / "star"), noun="dish")


def test_star_from_a_file(dish_star):
    items = {r.item_name_id: r for r in dish_star.dim_item.collect()}
    assert [items[k].item_key for k in ("alpha_hen_s", "alpha_hen_l", "garden_m")] == [1, 2, 3]
    garden, hen = items["garden_m"], items["alpha_hen_s"]
    assert (garden.unit_price, garden.min_unit_price, garden.max_unit_price) == (
        Decimal("10.01"), Decimal("10.00"), Decimal("10.01"))  # the median 10.005 rounds up
    assert garden.price_is_stable and garden.is_vegetarian and garden.ingredient_count == 2
    assert hen.item_short_name == "Alpha Hen" and hen.product_code == "alpha_hen"
    assert hen.ingredient_count == 3 and not hen.is_vegetarian and hen.item_category == "Chicken"
    names = {r.ingredient_name: (r.ingredient_key, r.is_cheese)
             for r in dish_star.dim_ingredient.collect()}
    assert names == {
        "?Nova Salami": (1, False), "Barbecued Chicken": (2, False), "Goat Cheese": (3, True),
        "Sun-Dried Tomatoes": (4, False), "Tomatoes": (5, False)}
    links = {tuple(r) for r in dish_star.bridge_item_ingredient.collect()}
    assert links == {(1, 1), (1, 2), (2, 2), (2, 4), (3, 3), (3, 5)}
    days = [r.full_date for r in dish_star.dim_date.orderBy("full_date").collect()]
    assert days == [date(2015, 1, d) for d in (1, 2, 3, 4)]
    fact = {r.order_item_id: r for r in dish_star.fact_order_items.collect()}
    assert fact[2].total_price == Decimal("41.50") and fact[2].time_key == 11
    assert (fact[1].order_line_count, fact[1].order_item_count, fact[1].order_total_value) == (
        2, 3, Decimal("51.50"))
    assert fact[3].price_variance_flag and not fact[2].price_variance_flag
    for name, df in dish_star.tables().items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in TABLES[name]], name


def test_views_are_registered_under_the_noun(spark, dish_star):
    register_views(dish_star, noun="dish")
    got = view(spark, "vw_sales_by_category", "dish_category").collect()
    assert [r.dish_category for r in got] == ["Chicken", "Classic"]
    assert spark.table("dim_dish").columns[0] == "dish_key"
    assert spark.table("vw_kpi_headline").first().total_dishs_sold == 5


def test_a_rerun_gives_the_same_tables(spark, write_csv, tmp_path, dish_star):
    path = write_csv(tmp_path / "again.csv", ROWS, noun="dish")
    again = star_from_csv(spark, path, str(tmp_path / "star2"), noun="dish")
    for name, df in dish_star.tables().items():
        assert sorted(map(str, df.collect())) == sorted(map(str, again.tables()[name].collect()))


def test_item_attributes_come_from_the_first_line(lines):
    frame = lines((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "a", "2015-01-01 10:00:00", 1, 7))
    frame = frame.withColumn("item_name", F.concat("item_name", F.col("item_id").cast("string")))
    assert dim.item_attributes(frame.orderBy(F.desc("item_id"))).first().item_name.endswith("1")


def test_large_groups_give_the_same_star(lines, tmp_path):
    rows = [(i % 4 if i % 3 else 0, "abcdefg"[i % 7], f"2015-01-0{1 + i % 4} 10:00:00", 1 + i % 3,
             5 + i % 2) for i in range(60)]

    def build(name, **options):
        folder = str(tmp_path / name)
        return build_star(lines(*rows), lambda df, n: staged(df, folder, n), **options)

    plain, split = build("plain"), build("split", one_task_rows=3)
    for name, df in plain.tables().items():
        assert sorted(map(str, df.collect())) == sorted(map(str, split.tables()[name].collect()))


def test_orphans_raise(star):
    fact = star((1, "a", "2015-01-01 10:00:00", 1, 5)).fact_order_items
    require_no_orphans(fact)
    with pytest.raises(RuntimeError, match="without an item"):
        require_no_orphans(fact.withColumn("item_key", F.lit(None)))


# --- publishing ------------------------------------------------------------------------------


def test_publish_and_read_back(spark, star, tmp_path):
    s = star((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "b", "2015-01-02 10:00:00", 2, 3))
    root = str(tmp_path / "wh")
    first = warehouse.publish(s.tables(), root, noun="dish")
    assert warehouse.current_run(spark, root) == first
    second = warehouse.publish(
        s.tables(), root, noun="dish", partition_by={"fact_order_items": ["date_key"]})
    assert warehouse.current_run(spark, root) == second != first
    loaded = warehouse.read_published(spark, root, noun="dish")
    for name, df in s.tables().items():
        assert sorted(map(str, df.select(*sorted(df.columns)).collect())) == sorted(
            map(str, loaded[name].select(*sorted(df.columns)).collect())), name
    report = warehouse.load_verification(loaded, s.tables()).collect()
    assert {r.status for r in report} == {"OK"}
    off = {**loaded, "dim_item": loaded["dim_item"].limit(1)}
    bad = warehouse.load_verification(off, s.tables()).filter("status = 'MISMATCH'").collect()
    assert [r.table for r in bad] == ["dim_item"]


def test_a_failed_load_leaves_the_former_run(spark, star, tmp_path):
    s = star((1, "a", "2015-01-01 10:00:00", 1, 5))
    root = str(tmp_path / "wh")
    run = warehouse.publish(s.tables(), root)
    broken = {**s.tables(), "fact_order_items": s.fact_order_items.withColumn(
        "quantity", F.raise_error(F.lit("lost")).cast("int"))}
    with pytest.raises(Exception):
        warehouse.publish(broken, root)
    assert warehouse.current_run(spark, root) == run


def test_missing_tables_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no table at .*dim_date"):
        warehouse.read_table(spark, str(tmp_path), "dim_date")
    with pytest.raises(FileNotFoundError, match="nothing published"):
        warehouse.current_run(spark, str(tmp_path))


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = [disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())]
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    table = warehouse.staged(spark.range(1000).repartition(5, "id"), str(tmp_path), "t")
    for _ in range(100):  # they go in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert table.count() == 1000
    warehouse.discard(spark, f"{tmp_path}/t")
    assert os.listdir(tmp_path) == []


def test_csv_extracts(spark, star, tmp_path):
    s = star((1, "a", "2015-01-01 10:00:00", 1, 5))
    warehouse.export_csv({"vw_daily_sales": views.daily_sales(s)}, str(tmp_path), noun="dish")
    got = spark.read.option("header", True).csv(str(tmp_path / "vw_daily_sales")).first()
    assert (got.revenue, got.dishs_sold) == ("5.00", "1")


def test_extracts_are_compressed_unless_asked(spark, star, tmp_path):
    s = star((1, "a", "2015-01-01 10:00:00", 1, 5))
    view = {"vw_fact_enriched": views.fact_enriched(s)}
    for compression, suffix in (({}, ".csv.gz"), ({"compression": "none"}, ".csv")):
        folder = tmp_path / suffix[1:]
        warehouse.export_csv(view, str(folder), **compression)
        parts = [n for n in os.listdir(folder / "vw_fact_enriched") if n.startswith("part-")]
        assert parts and all(n.endswith(suffix) for n in parts)
        got = spark.read.option("header", True).csv(str(folder / "vw_fact_enriched")).collect()
        assert [(r.order_item_id, r.full_date, r.total_price) for r in got] == [("1", "2015-01-01", "5.00")]


def test_lines_meet_their_items_before_their_days(star):
    s = star((1, "a", "2015-01-01 10:00:00", 1, 5))
    plan = views.fact_enriched(s)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert ["item_key" in j for j in joins] == [False, False, True]  # the first join is printed last


# --- quality gate ----------------------------------------------------------------------------


def broken(star_, table, change):
    return {**star_.tables(), table: change(star_.tables()[table])}


CHANGES = [
    ("fact primary key is unique", "fact_order_items", lambda d: d.unionByName(d)),
    ("no null foreign keys in fact", "fact_order_items",
     lambda d: d.withColumn("order_id", F.lit(None).cast("bigint"))),
    ("fact -> dim_item referential integrity", "dim_item", lambda d: d.filter("item_key > 1")),
    ("fact -> dim_date referential integrity", "dim_date", lambda d: d.filter("day_of_month > 1")),
    ("fact -> dim_time referential integrity", "dim_time", lambda d: d.filter("time_key < 9")),
    ("dim_date has no gaps", "dim_date", lambda d: d.filter("day_of_month <> 2")),
    ("all measures are positive", "fact_order_items",
     lambda d: d.withColumn("quantity", F.lit(0))),
    ("revenue = unit_price x quantity", "fact_order_items",
     lambda d: d.withColumn("total_price", F.col("total_price") + F.lit(Decimal("0.02")))),
    ("order totals reconcile to line items", "fact_order_items",
     lambda d: d.withColumn("order_total_value", F.col("order_total_value") + 1)),
    ("dim_item natural key is unique", "dim_item", lambda d: d.unionByName(d)),
    ("ingredient bridge has no orphans", "dim_ingredient", lambda d: d.limit(0)),
    ("item_category domain is closed", "dim_item",
     lambda d: d.withColumn("item_category", F.lit("Other"))),
    ("unit price is stable per product", "dim_item",
     lambda d: d.withColumn("price_is_stable", F.lit(False))),
]


def test_quality_gate(star):
    s = star((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "b", "2015-01-03 10:00:00", 2, 3))
    report = quality.require_quality(quality.quality_report(s.tables(), 0))
    assert {r.status for r in report.collect()} == {"PASS"} and report.count() == 14
    assert tuple(quality.quality_summary(report).first()) == (14, 0, 0, 0)
    for check, table, change in CHANGES:
        got = {r.check: r for r in quality.quality_report(broken(s, table, change), 0).collect()}
        want = "WARN" if got[check].severity == "warning" else "FAIL"
        assert got[check].status == want and got[check].detail, check
    many = {r.check: r.status for r in quality.quality_report(s.tables(), 1).collect()}
    assert many["rejection rate below 1%"] == "WARN"
    with pytest.raises(RuntimeError, match="fact primary key is unique: 2 repeated"):
        quality.require_quality(
            quality.quality_report(broken(s, "fact_order_items", lambda d: d.unionByName(d)), 0))


def test_declared_constraints(star):
    s = star((1, "a", "2015-01-01 10:00:00", 1, 5))
    assert all(r.bad_count == 0 for r in quality.constraint_report(s.tables()).collect())
    off = broken(s, "bridge_item_ingredient", lambda d: d.unionByName(d).withColumn(
        "item_key", F.lit(7).cast("bigint")))
    bad = {(r.table, r.constraint) for r in quality.constraint_report(off).collect() if r.bad_count}
    assert bad == {("bridge_item_ingredient", "unique"), ("bridge_item_ingredient", "foreign key")}
