from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators import quarantine
from tillstar.sources.raw import raw_lines, read_raw_csv
from tillstar.sources.warehouse import staged

BAD = [
    ({"item_id": "x"}, "unparseable identifier"),
    ({"order_date": "2015-01-31"}, "unparseable order_date (expected DD-MM-YYYY)"),
    ({"order_time": "25:00:00"}, "unparseable order_time (expected HH:MM:SS)"),
    ({"quantity": "0"}, "quantity must be a positive integer"),
    ({"unit_price": "-1"}, "unit_price must be positive"),
    ({"item_size": "Q"}, "unknown item_size"),
    ({"item_name_id": "  "}, "missing product key"),
]


def reasons(judged):
    return {r._row: r.reject_reason for r in judged.select("_row", "reject_reason").collect()}


def test_first_broken_rule_names_the_reason(raw):
    rows = [{"item_id": 100 + i, "order_id": 100 + i, **bad} for i, (bad, _) in enumerate(BAD)]
    rows.append({"item_id": 1})
    rows.append({"item_id": 1, "order_id": 2})  # same key
    rows.append({"item_id": 3})  # same content as the first good one
    rows.append({"item_id": "y", "quantity": "0", "item_size": "Q"})  # breaks three rules
    got = reasons(quarantine.judge_lines(raw(*rows)))
    want = [r for _, r in BAD] + [
        None, "duplicate item_id", "duplicate line item within order", "unparseable identifier",
    ]
    assert [got[i] for i in range(len(want))] == want


def test_a_copy_survives_if_the_first_one_was_rejected(raw):
    rows = raw({"quantity": "0"}, {"quantity": "2"}, {"quantity": "3"})
    judged = quarantine.judge_lines(rows)
    assert reasons(judged) == {
        0: "quantity must be a positive integer", 1: None, 2: "duplicate item_id"}
    assert [r.quantity for r in quarantine.clean_lines(rows).collect()] == [2]


def test_clean_lines_are_the_good_lines(raw):
    rows = [
        {"item_id": i % 7, "order_id": i % 3, "quantity": i % 4, "item_size": "ml"[i % 2]}
        for i in range(60)
    ]
    frame = raw(*rows)
    good = quarantine.good_lines(quarantine.judge_lines(frame))
    assert Counter(good.collect()) == Counter(quarantine.clean_lines(frame).collect())
    judged = quarantine.judge_lines(frame)
    assert judged.count() == 60
    summary = quarantine.run_summary(judged).first()
    assert summary.fact_rows == good.count() and summary.source_rows == 60
    assert summary.rejected_rows == quarantine.rejected_rows(judged).count()


def test_clean_lines_shuffle_keys_alone_where_rows_are_written(raw, tmp_path):
    frame = raw(*[
        {"item_id": i % 7, "order_id": i % 3, "quantity": i % 4, "item_size": "ml"[i % 2]} for i in range(60)
    ]).repartition(3)
    names = []

    def stage(df, name):
        names.append(name)
        text = df._jdf.queryExecution().executedPlan().toString()
        if name.startswith("kept"):
            assert "item_ingredients" not in text.split("Window ")[0]
        return staged(df, str(tmp_path), name)

    written = quarantine.clean_lines(frame, stage=stage)
    assert "Window" not in written._jdf.queryExecution().executedPlan().toString()
    assert Counter(written.collect()) == Counter(quarantine.clean_lines(frame).collect())
    assert names == ["good", "kept-0", "kept-1"]


def test_rejected_rows_keep_the_raw_text(raw):
    got = quarantine.rejected_rows(quarantine.judge_lines(raw({"item_size": " q "}))).first()
    assert got.item_size == " q " and got.reject_reason == "unknown item_size"


def test_variance_flag(raw):
    rows = raw(
        {"item_id": 1, "quantity": 2, "total_price": "26.50"},
        {"item_id": 2, "quantity": 3, "total_price": "39.76"},
        {"item_id": 3, "quantity": 4, "total_price": "53.02"},
        {"item_id": 4, "quantity": 5, "total_price": ""},
    )
    got = {r.item_id: (r.price_variance_flag, r.total_price)
           for r in quarantine.clean_lines(rows).collect()}
    assert got == {1: (False, Decimal("26.50")), 2: (False, Decimal("39.75")),
                   3: (True, Decimal("53.00")), 4: (True, Decimal("66.25"))}


def test_reading_a_file_with_another_noun(spark, write_csv, tmp_path):
    path = write_csv(tmp_path / "r.csv", [{"item_id": 5, "item_name": 'A "b", c'},
                                          {"item_id": 5, "total_price": ""}], noun="dish")
    lines = read_raw_csv(spark, path, noun="dish")
    first, second = lines.orderBy("_row").collect()
    assert first.item_name == 'A "b", c' and second.total_price == ""
    judged = quarantine.judge_lines(lines, noun="dish")
    assert [r.reject_reason for r in judged.orderBy("_row").collect()] == [None, "duplicate dish_id"]


def test_missing_columns_are_named(spark, write_csv, tmp_path):
    path = write_csv(tmp_path / "r.csv", [{}], columns=["item_id", "order_id"])
    with pytest.raises(ValueError, match="lack.*unit_price.*item_category"):
        read_raw_csv(spark, path)


def test_extra_columns_are_dropped(raw):
    frame = raw({}).withColumn("extra", F.lit(1))
    assert "extra" not in raw_lines(frame).columns


def test_summary_is_counted_while_rows_are_written(spark, raw, tmp_path):
    judged = quarantine.judge_lines(raw({"item_id": 1}, {"item_id": 1}, {"item_id": 2, "quantity": 0},
                             {"item_id": 3, "order_id": 5, "total_price": "1.00"}))
    written, summary = quarantine.staged_with_summary(judged, lambda df, name: staged(df, str(tmp_path), name))
    assert summary.collect() == quarantine.run_summary(written).collect() == [(4, 2, 2, 1)]


@pytest.mark.parametrize("broadcast_rows", [10**9, 0])
def test_written_rows_are_judged_without_a_shuffle_of_rows(spark, raw, tmp_path, monkeypatch, broadcast_rows):
    monkeypatch.setattr(quarantine, "BROADCAST_ROWS", broadcast_rows)
    rows = [
        {"item_id": "x" if i % 11 == 3 else i % 70, "order_id": i % 9, "quantity": i % 4,
         "item_name_id": "ab"[i % 2]}
        for i in range(200)
    ]
    frame = raw(*rows).repartition(5)
    want = reasons(quarantine.judge_lines(frame))
    judged = quarantine.judge_lines(frame, stage=lambda df, name: staged(df, str(tmp_path), name))
    assert reasons(judged) == want and len(set(want.values())) == 5 and judged.columns.count("_row") == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quarantine.rejected_rows(judged)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The one join by order is with the orders that several repeats share: a written table, as a rule empty.
    assert plan.count("SortMergeJoin [") == (1 if broadcast_rows else 3)


def test_known_keys_count_as_seen(spark, raw):
    reason = "duplicate item_id"
    known = {reason: spark.createDataFrame([(1,)], "item_id bigint")}
    got = reasons(quarantine.judge_lines(raw({"item_id": 1}, {"item_id": 2, "order_id": 2}), known=known))
    assert got == {0: reason, 1: None}


def test_written_or_not_rows_that_share_their_order_come_out_alike(spark, raw, tmp_path):
    rows = [{"item_id": i % 6, "order_id": i % 4, "quantity": i % 3} for i in range(24)]
    frame = raw(*rows)
    twice = frame.unionByName(frame.filter("_row % 5 < 2"))
    want = Counter((r._row, r.reject_reason) for r in quarantine.judge_lines(twice).collect())
    written = quarantine.judge_lines(twice, stage=lambda df, name: staged(df, str(tmp_path), name))
    assert Counter((r._row, r.reject_reason) for r in written.collect()) == want


def test_every_bit_of_a_bitmap_is_found(spark):
    """Rows of three buckets, one of which keeps nothing, by a number and a batch."""
    rows = spark.range(70000).select(F.col("id").alias("n"), F.lit(3).alias("b"))
    kept = rows.filter("n % 7 IN (0, 3) AND (n < 32768 OR n >= 65536)")
    for within in ((), ("b",)):
        bits = quarantine.bitmaps(kept, "n", within)
        for small in (True, False):
            got = quarantine.kept_by_bits(rows, bits, "n", small, within).filter("_kept")
            assert got.exceptAll(kept.withColumn("_kept", F.lit(True))).count() == 0
            assert got.count() == kept.count()


def test_rows_known_to_be_unique_are_not_searched_for_shared_order(raw, tmp_path):
    rows = raw(*[{"item_id": i % 4, "order_id": i % 3, "quantity": i % 5} for i in range(30)])
    names = []

    def stage(df, name):
        names.append(name)
        return staged(df, str(tmp_path), name)

    judged = quarantine.judge_lines(rows, stage=stage, unique=True)
    assert names == ["judged", "kept-0", "kept-1"]
    assert reasons(judged) == reasons(quarantine.judge_lines(rows))
