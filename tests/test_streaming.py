import os
import shutil
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators.quarantine import judge_lines, rejected_rows
from tillstar.streaming import hourly, incremental, quarantine
from tillstar.streaming.runs import Runs
from tillstar.sources.warehouse import staged
from tillstar.streaming.sources import Inbox, in_turn, one_batch_each


def same(rows):
    return rows


@pytest.fixture
def load(spark, tmp_path):
    """load(part, ...) -> ids loaded after each delivery."""
    target, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run(*parts):
        after = []

        def take(inbox):
            incremental.incremental_load(inbox, same, target, state, ["item_id"], "day")
            after.append(sorted(r.item_id for r in incremental.loaded_lines(spark, target).collect()))

        days = [p.withColumn("day", F.col("order_ts").cast("date")) for p in parts]
        in_turn(days, str(tmp_path / "in"), take)
        return after

    run.target, run.state, run.folder = target, state, str(tmp_path / "in")
    return run


def test_incremental_load_takes_every_line_once(lines, load):
    one = lines((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "b", "2015-01-02 10:00:00", 1, 6))
    more = lines((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "b", "2015-01-02 10:00:00", 1, 6),
                 (3, "c", "2015-01-02 11:00:00", 1, 7))
    assert load(one.unionByName(one), one, more, one.limit(0), more) == [
        [1, 2], [1, 2], [1, 2, 3], [1, 2, 3], [1, 2, 3]]


def test_a_key_on_another_day_is_not_loaded_again(spark, lines, load):
    load(*[lines((1, "a", when, 1, 5)) for when in ("2015-01-02 10:00:00", "2015-01-01 10:00:00")])
    days = [str(r.day) for r in incremental.loaded_lines(spark, load.target).collect()]
    assert days == ["2015-01-02"]


def test_known_keys_are_not_read_again(lines, load):
    """Loaded lines may be gone: what a stream knows is in its state store."""
    one = lines((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "b", "2015-01-02 10:00:00", 1, 6))
    load(one)
    for name in os.listdir(load.target):
        shutil.rmtree(f"{load.target}/{name}")
    more = lines((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "b", "2015-01-02 10:00:00", 1, 6),
                 (3, "c", "2015-01-02 11:00:00", 1, 7))
    assert load(more) == [[3]]


def test_a_repeated_micro_batch_changes_nothing(spark, lines, load):
    one = lines((1, "a", "2015-01-01 10:00:00", 1, 5))
    two = lines((1, "a", "2015-01-01 10:00:00", 1, 5), (2, "b", "2015-01-02 10:00:00", 1, 6))
    load(one, two)
    last = max(int(n) for n in os.listdir(f"{load.state}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):  # as if the driver was lost before the commit
        os.remove(f"{load.state}/commits/{name}")
    inbox = Inbox(spark, load.folder, two.withColumn("day", F.col("order_ts").cast("date")).schema)
    incremental.incremental_load(inbox, same, load.target, load.state, ["item_id"], "day")
    got = incremental.loaded_lines(spark, load.target).collect()
    assert sorted(r.item_id for r in got) == [1, 2]


def test_rows_of_a_micro_batch_after_the_log_is_compacted(spark, tmp_path):
    folder, state, seen = str(tmp_path / "in"), str(tmp_path / "state"), []

    def write(rows, new_keys, number):
        seen.append((sorted(r.id for r in rows.collect()), sorted(r.k for r in new_keys.collect())))

    for i in range(23):
        spark.range(i, i + 2).selectExpr("id", "id % 7 AS k").coalesce(1).write.mode("append").parquet(folder)
    inbox = Inbox(spark, folder, spark.range(1).selectExpr("id", "id AS k").schema, files_per_batch=1)
    incremental.run_on_new_keys(inbox, same, ["k"], state, str(tmp_path / "scratch"), write)
    assert [r for r, _ in seen] == [[i, i + 1] for i in range(23)]
    assert [k for _, k in seen] == [[0, 1]] + [[i] for i in range(2, 7)] + [[]] * 17


def hours(spark, target, state, **kw):
    rows = hourly.hourly_result(spark, target, state, **kw).collect()
    return {r.hour_start: (r.lines, r.revenue) for r in rows}


def test_hours_close_once_and_late_lines_are_added(spark, lines, tmp_path):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    parts = [
        lines((1, "a", "2015-01-01 10:05:00", 1, 5), (2, "b", "2015-01-01 11:59:59", 2, 6)),
        lines((3, "a", "2015-01-01 11:30:00", 1, 4), (4, "a", "2015-01-01 14:00:00", 1, 1)),
        lines((5, "a", "2015-01-01 10:59:59.999", 1, 2), (6, "a", "2015-01-01 14:10:00", 1, 3)),
    ]
    parts[2] = parts[2].unionByName(parts[0].limit(1).withColumn("order_ts", F.lit(None).cast("timestamp_ntz")))
    in_turn(parts, str(tmp_path / "in"),
            lambda inbox: hourly.run_hourly(inbox, same, target, state, "30 minutes"))
    ten, eleven, two = (datetime(2015, 1, 1, h) for h in (10, 11, 14))
    want = {ten: (2, Decimal("7.00")), eleven: (2, Decimal("16.00")), None: (1, Decimal("5.00"))}
    assert hours(spark, target, state, include_open=False) == want
    assert hours(spark, target, state) == want | {two: (2, Decimal("4.00"))}
    kinds = {r.kind: r.lines for r in hourly.arrivals(spark, target).collect()}
    assert kinds == {"closed": 3, "late": 1, "untimed": 1}


@pytest.mark.parametrize("no_data_batches", ["true", "false"])
def test_lines_in_any_order_are_counted(spark, lines, tmp_path, no_data_batches):
    """Many micro-batches in one run: hours close while lines of theirs still come in."""
    target, state, folder = (str(tmp_path / n) for n in ("out", "state", "in"))
    times = [f"2015-03-{1 + (i * 11) % 5:02d} {(i * 7) % 24:02d}:{i % 60:02d}:00" for i in range(60)]
    for start in range(0, 60, 5):
        part = lines(*[(i, "a", times[i], 1, 5) for i in range(start, start + 5)])
        part.coalesce(1).write.mode("append").parquet(folder)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", no_data_batches)
    try:
        hourly.run_hourly(Inbox(spark, folder, part.schema, 1), same, target, state, "5 hours", fan_in=3)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    want = {}
    for t in times:
        hour = datetime.fromisoformat(t).replace(minute=0)
        want[hour] = want.get(hour, 0) + 1
    assert {h: n for h, (n, _) in hours(spark, target, state).items()} == want
    assert len(os.listdir(f"{target}/sums")) <= 8  # two for each of the levels of 3, 9 ... batches


def test_runs_survive_a_merge_that_broke_off(spark, tmp_path):
    runs = Runs(spark, str(tmp_path), "v bigint", lambda df: df.agg(F.sum("v").alias("v")), 4)
    assert runs.read() is None
    for number in range(6):
        runs.add(spark.range(1).selectExpr(f"{10 ** number} AS v"), number)
    assert runs.live() == [(1, 0, 3), (0, 4, 4), (0, 5, 5)]
    runs.add(spark.range(1).selectExpr("100 AS v"), 2)  # done again after the merge
    runs.add(spark.range(1).selectExpr("100000 AS v"), 5)
    (tmp_path / "1.4-7").mkdir()  # not written whole
    assert runs.read().first().v == 111111


def test_stream_quarantine(spark, raw, tmp_path):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    content = {"order_id": 7, "order_time": "10:00:00"}
    parts = [
        raw({"item_id": 1}, {"item_id": 1}, {"item_id": 2, "quantity": 0}, {"item_id": 4, **content}),
        raw({"item_id": 1}, {"item_id": 2, **content}, {"item_id": 3, "order_id": 3}),
        raw({"item_id": 2, "order_id": 9}, {"item_id": 5, **content}, {"item_id": 6, "order_id": 6}),
    ]
    in_turn(parts, str(tmp_path / "in"),
            lambda inbox: quarantine.run_quarantine(inbox, target, state))
    rejected, accepted = (df.collect() for df in quarantine.outcome(spark, target))
    assert sorted((r.item_id, r.reject_reason) for r in rejected) == [
        ("1", "duplicate item_id"), ("1", "duplicate item_id"),
        ("2", "duplicate item_id"),  # its line key was used by a repeated content
        ("2", "duplicate line item within order"), ("2", "quantity must be a positive integer"),
        ("5", "duplicate line item within order")]
    assert sorted(r.item_id for r in accepted) == [1, 3, 4, 6]


def test_stream_quarantine_is_a_batch_run_in_parts(spark, raw, tmp_path):
    """Lines in order of arrival: the same rows with the same reasons, also within a micro-batch."""
    rows = [{"item_id": 1 + (i * i) % 11, "order_id": 1 + i % 3, "quantity": (i * 5) % 4} for i in range(40)]
    whole = raw(*rows)
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    in_turn([whole.filter(f"_row >= {a} AND _row < {a + 10}") for a in range(0, 40, 10)],
            str(tmp_path / "in"), lambda inbox: quarantine.run_quarantine(inbox, target, state))
    rejected, accepted = quarantine.outcome(spark, target)
    judged = judge_lines(whole)
    columns = [c for c in rejected.columns if c not in ("rule", "batch")]
    assert sorted(map(tuple, rejected.select(columns).collect())) == sorted(
        map(tuple, rejected_rows(judged).select(columns).collect()))
    good = judged.filter("reject_reason IS NULL").select("item_id").collect()
    assert sorted(r.item_id for r in accepted.collect()) == sorted(r.item_id for r in good)


def test_parts_make_micro_batches_of_their_own(spark, raw, tmp_path):
    """A part with fewer rows than another has files is still one micro-batch, of both streams."""
    content = {"order_id": 7, "order_time": "10:00:00"}
    parts = [
        raw({"item_id": 1}, {"item_id": 2, **content}, {"item_id": 1}).repartition(3),
        raw({"item_id": 1}).coalesce(1),
        raw({"item_id": 3, **content}, {"item_id": 4, "order_id": 4}).repartition(2),
    ]
    inbox = one_batch_each(parts, str(tmp_path / "in"), files=None)
    target = str(tmp_path / "out")
    quarantine.run_quarantine(inbox, target, str(tmp_path / "state"))
    rejected, accepted = (spark.read.parquet(f"{target}/{n}").collect() for n in ("rejected", "accepted"))
    assert sorted((r.item_id, r.reject_reason, r.batch) for r in rejected) == [
        ("1", "duplicate item_id", 0), ("1", "duplicate item_id", 1),
        ("3", "duplicate line item within order", 2)]
    assert sorted((r.item_id, r.batch) for r in accepted) == [(1, 0), (2, 0), (4, 2)]
    assert sorted(os.listdir(tmp_path)) == ["in", "out", "state"]
    assert "scratch" not in os.listdir(target)


def test_a_duplicate_rule_leaves_whole_lines_where_they_are(spark, raw, tmp_path):
    """Only keys are shuffled: rows are read from where they were written, next to broadcast bitmaps."""
    rows = [{"item_id": i % 5, "order_id": i} for i in range(20)]
    typed = quarantine.parse_lines(raw(*rows)).withColumn("reject_reason", F.lit(None).cast("string"))
    typed = staged(typed.withColumn("_place", F.monotonically_increasing_id()), str(tmp_path), "typed")
    new = spark.range(4).select(F.col("id").alias("item_id"))
    judged = quarantine._judged(typed, new, ["item_id"], ["_row"], "again", str(tmp_path))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    good = judged.filter("reject_reason IS NULL").select("_row").collect()
    assert sorted(r[0] for r in good) == [0, 1, 2, 3]  # key 4 was seen before
    assert judged.count() == 20
