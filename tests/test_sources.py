"""Order lines made of the retail tables."""

from datetime import datetime

import pytest

from tillstar.sources import tables


@pytest.fixture(scope="module")
def retail(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("retail"))
    day = datetime(1996, 3, 4)
    line = (1, 7, 3, 2, 4.0, 10.0, 0.0, 0.0, "N", "O", day)
    spark.createDataFrame(
        [line, line, (2, 8, 3, 1, 5.0, 20.0, 0.0, 0.0, "N", "O", day), (None, 8, *line[2:]), (9, 8, *line[2:])],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz",
    ).repartition(2).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, day), (2, day)], "o_orderkey bigint, o_orderdate timestamp_ntz").write.parquet(
        f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(7, "hot bolt", "Brand#1", "SMALL", 5), (8, "red ring", "Brand#2", "LARGE", 45)],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    ).write.parquet(f"{folder}/part.parquet")
    return folder


def test_dates_are_joined_before_product_texts(spark, retail):
    for frame in (tables.retail_text(spark, retail), tables.retail_lines(spark, retail)):
        text = frame._jdf.queryExecution().optimizedPlan().toString()
        assert text.index("Join Inner, (l_partkey") < text.index("Join Inner, (l_orderkey")


def test_copies_of_a_line_differ_by_place_only(spark, retail):
    rows = tables.retail_text(spark, retail).collect()
    assert sorted(r.item_id for r in rows) == ["12", "12", "21"]
    assert sorted(r.item_name_id for r in rows) == ["BRAND#1_7_S", "BRAND#1_7_S", "BRAND#2_8_XXL"]
    first, second = sorted((r for r in rows if r.item_id == "12"), key=lambda r: r._row.place)
    assert first._row != second._row and first[:12] == second[:12]
    assert [r.item_id for r in tables.retail_lines(spark, retail).orderBy("item_id").collect()] == [12, 21]


def test_csv_files_hold_the_lines_in_order(spark, retail):
    from tillstar import catalog
    from tillstar.schemas import RAW_COLUMNS
    from tillstar.sources.raw import read_raw_csv

    path = catalog._csv_files(spark, retail)
    read = read_raw_csv(spark, path)
    assert all(f.endswith(".csv.gz") for f in read.inputFiles())
    want = tables.retail_text(spark, retail).orderBy("_row").select(*RAW_COLUMNS).collect()
    assert read.orderBy("_row").select(*RAW_COLUMNS).collect() == want


def test_only_lines_without_text_are_dealt_to_files(spark, retail):
    dealt = tables.dated_lines(spark, retail)
    assert not {"item_name", "item_ingredients", "_row"} & set(dealt.columns)
    assert tables.as_text(dealt).collect() == tables.retail_text(spark, retail).collect()


def test_recipe_flags_read_the_lines_once(spark, retail):
    from tillstar import catalog

    found = catalog.QUERIES["recipe_flags"](spark, retail)
    assert not [f for f in found.inputFiles() if "/lineitem.parquet" in f]
    assert {(r.name, r.ingredient_count, r.flag) for r in found.collect()} == {
        ("brand#1_7_s", 3, True), ("brand#2_8_xxl", 2, True),
        ("Hot", 1, False), ("Bolt", 1, False), ("Cheese", 1, True), ("Red", 1, False), ("Ring", 1, False),
    }


def test_times_of_any_order_key(spark):
    keys = [0, 5, 61, 1500, -77, -5]
    day = datetime(1996, 3, 4)
    rows = [(k, 7, 3, day, 4.0, 10.0, 0.0, 0.0, "N", "O", 2, k, day, "hot bolt", "Brand#1", "SMALL", 5) for k in keys]
    dated = spark.createDataFrame(
        rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp_ntz, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_linenumber int, place bigint, o_orderdate timestamp_ntz, p_name string, p_brand string, p_type string, "
        "p_size int")
    times = {int(r.order_id): r.order_time for r in tables.as_text(dated).collect()}
    assert times == {0: "00:00:00", 5: "05:05:00", 61: "13:01:00", 1500: "12:00:00", -77: "-5:-17:00",
                     -5: "-5:-5:00"}
