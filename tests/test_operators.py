import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.operators import affinity, groups, history, ordered, profiling, selection


def skewed(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(i, 0 if rng.random() < 0.4 else rng.randrange(1, 40), rng.randrange(100))
            for i in range(n)]
    rows.append((n, None, 5))
    return rows, spark.createDataFrame(rows, "id int, k int, v int").repartition(5)


def test_totals_of_groups_of_any_size(spark):
    rows, df = skewed(spark)
    total, count = defaultdict(int), Counter()
    for _, k, v in rows:
        total[k] += v
        count[k] += 1
    got = groups.with_totals(
        df, ["k"], {"t": F.sum("v"), "n": F.count("*")}
    ).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.t, r.n) == (total[r.k], count[r.k])


def test_repeats_in_groups_of_any_size(spark):
    rows, df = skewed(spark)
    first = {}
    for i, k, v in rows:
        if v % 5:
            first.setdefault(k, i)
    got = groups.mark_repeats(df, ["k"], "id", F.col("v") % 5 != 0, "again").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.again == (r.v % 5 != 0 and first[r.k] != r.id)


def test_keep_first(spark):
    rows, df = skewed(spark)
    got = {r.k: r.id for r in groups.keep_first(df, ["k"], ["id"]).collect()}
    want = {}
    for i, k, _ in rows:
        want.setdefault(k, i)
    assert got == want


@pytest.mark.parametrize("limit", [7, 10**6])
def test_dense_numbers(spark, limit):
    names = [f"n{i:03d}" for i in range(60)]
    random.Random(3).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(4)
    got = {r.name: r.key for r in ordered.number_rows(df, ["name"], "key", limit=limit).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names), 1)}


@pytest.mark.parametrize("limit", [3, 10**6])
def test_ranks_and_running_totals(spark, limit):
    data = {"a": 5, "b": 3, "c": 3, "d": 1, "e": 9, "f": 1, "g": 1, "h": 7}
    df = spark.createDataFrame(list(data.items()), "code string, v bigint")
    got = ordered.rank_from_top(
        df, "v", ["code"], len(data), rank="r", dense_rank="d", position="p",
        running={"run": "v"}, running_with_ties="ties", limit=limit,
    ).collect()
    order = sorted(data, key=lambda c: (-data[c], c))
    for row in got:
        mine = data[row.code]
        assert row.r == 1 + sum(v > mine for v in data.values())
        assert row.d == len({v for v in data.values() if v >= mine})
        assert row.p == 1 + order.index(row.code)
        assert row.run == sum(data[c] for c in order[: row.p])
        assert row.ties == sum(v for v in data.values() if v >= mine)


@pytest.mark.parametrize("limit", [4, 10**6])
def test_quantiles_match_numpy(spark, limit):
    rng = random.Random(5)
    values = [rng.choice([1, 2, 2, 3, 8, 13, 40]) * rng.randrange(1, 5) for _ in range(101)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    got = ordered.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.8, 1.0], limit).first()
    assert np.allclose(list(got), np.quantile(values, [0.0, 0.25, 0.5, 0.8, 1.0]))


@pytest.mark.parametrize("block, min_orders", [(200, 4), (3, 4), (1, 4), (2, 1)])
def test_affinity_is_exact_with_baskets_in_blocks(spark, block, min_orders):
    rng = random.Random(11)
    baskets = {i: set(rng.sample("abcdefgh", rng.randrange(1, 6))) for i in range(40)}
    baskets[40] = set("abcdefgh")
    rows = [(o, c) for o, codes in baskets.items() for c in codes for _ in range(rng.choice([1, 2]))]
    df = spark.createDataFrame(rows, "o int, c string")
    single = Counter(c for codes in baskets.values() for c in codes)
    pairs = Counter(p for codes in baskets.values() for p in combinations(sorted(codes), 2))
    want = {p: n for p, n in pairs.items() if n >= min_orders}
    got = affinity.basket_affinity(
        df, "o", "c", F.lit(len(baskets)), 8, min_orders, block
    ).collect()
    assert {(r.a, r.b): r.orders_together for r in got} == want
    for r in got:
        n, a, b, k = len(baskets), single[r.a], single[r.b], r.orders_together
        assert abs(float(r.lift) - (k / n) / ((a / n) * (b / n))) <= 0.0005 + 1e-9
        assert abs(float(r.support_pct) - 100 * k / n) <= 0.0005 + 1e-9
        assert abs(float(r.confidence_b_to_a_pct) - 100 * k / b) <= 0.005 + 1e-9


def test_one_pair_join_whatever_the_baskets(spark):
    df = spark.range(3_000).selectExpr("id % 2 AS basket", "id div 2 AS code")
    pairs = affinity.pair_counts(df, 2, block=100)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert pairs.count() == 1500 * 1499 // 2


def test_pairs_that_share_too_little_stay_in_the_join(spark):
    rng = random.Random(4)
    rows = {(b, c) for c in range(120) for b in rng.sample(range(400), 15)}
    rows |= {(b, c) for c in (120, 121) for b in range(15 + c - 120)}  # two alike
    rows |= {(b, 122) for b in range(400)}  # more baskets than a signature has bits
    df = spark.createDataFrame(sorted(rows, key=str), "basket int, code int")
    of = defaultdict(set)
    for b, c in rows:
        of[c].add(b)
    want = {(a, b): len(of[a] & of[b]) for a, b in combinations(sorted(of), 2)}
    counted = affinity.pair_counts(df, 6, block=7)
    assert {(r.a, r.b): r.orders_together for r in counted.collect()} == {p: n for p, n in want.items() if n >= 6}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_count" in next(line for line in plan.splitlines() if "Join " in line)


@pytest.mark.parametrize("digit_bits", [3, 16])
def test_quantiles_by_digits_match_numpy(spark, digit_bits):
    rng = random.Random(6)
    groups = {
        "small": [rng.choice([-7, 0, 1, 1, 2, 900]) for _ in range(101)],
        "wide": [rng.randrange(-10**18, 10**18) for _ in range(50)], "one": [5], "same": [-3] * 9,
    }
    rows = Counter((g, v) for g, vs in groups.items() for v in vs)
    counts = spark.createDataFrame([(g, v, n) for (g, v), n in rows.items()], "g string, v bigint, n bigint")
    counts = counts.unionByName(spark.createDataFrame([("small", None, 4)], counts.schema))
    fractions = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = selection.quantiles(counts, "g", "v", "n", fractions, digit_bits)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert np.allclose(list(map(float, got[g])), np.quantile(np.array(vs, float), fractions), rtol=1e-12)
    assert selection.quantiles(counts.limit(0), "g", "v", "n", fractions) == {}


def test_versions(spark):
    rows = [("a", "2015-01-01", 1, 10), ("a", "2015-01-01", 2, 11), ("a", "2015-01-05", 3, 11),
            ("a", "2015-01-09", 4, 12), ("b", "2015-01-02", 5, 7)]
    df = spark.createDataFrame(rows, "k string, d string, n int, v int").withColumn(
        "d", F.col("d").cast("date"))
    df = df.withColumn("w", F.when(F.col("n") < 3, "x").otherwise("y"))
    got = {(r.k, r.version): (r.v, r.w, str(r.valid_from), str(r.valid_to), r.is_current)
           for r in history.versions(df, "k", "d", ["v", "w"], "n").collect()}
    assert got == {
        ("a", 1): (11, "x", "2015-01-01", "2015-01-04", False),
        ("a", 2): (11, "y", "2015-01-05", "2015-01-08", False),
        ("a", 3): (12, "y", "2015-01-09", "None", True),
        ("b", 1): (7, "y", "2015-01-02", "None", True),
    }


def test_profile_survives_a_huge_value(spark, raw):
    from tillstar.operators import profiling

    rows = [{"item_id": i, "total_price": p} for i, p in
            enumerate(["1.00", "2.00", "9999999999999.00", "n/a"])]
    got = {r.measure: r for r in profiling.numeric(raw(*rows).drop("_row")).collect()}["total_price"]
    assert (got["count"], got.non_numeric, str(got.max)) == (3, 1, "9999999999999.00")


@pytest.mark.parametrize("prices, std", [
    (["1000000000.00", "1000000000.50"], "0.3536"), (["16501701907.01"] * 33, "0.0000"),
    (["-5", "5"], "7.0711"), (["3.00"], None), ([], None),
    (["90000000000.01", "90000000000.02", "90000000000.05", "0.01"], "45000000000.0083"),
])
def test_deviation_is_exact_for_large_amounts(raw, prices, std):
    rows = [{"item_id": i, "total_price": p} for i, p in enumerate(prices)] or [{}]
    lines = raw(*rows).drop("_row").limit(len(prices))
    got = {r.measure: r for r in profiling.numeric(lines).collect()}["total_price"]
    assert (got["count"], None if got["std"] is None else str(got["std"])) == (len(prices), std)


def test_counts_of_many_columns_read_the_lines_once(spark):
    rows = [(i % 3 or None, "" if i % 4 else None, i) for i in range(50)] + [(None, None, 1), (0, "0", 1)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(4)
    found = profiling.tallies(
        df, {"a": ["a"], "b": ["b"], "ab": ["a", "b"], "ba": ["b", "a"], "c": ["c"]},
        {"high": F.col("c") > 40, "unknown": F.col("a") > 1},
    )
    assert found.first().asDict() == {
        "rows": 52, "a": len({r[0] for r in rows}), "b": len({r[1] for r in rows}),
        "ab": len({r[:2] for r in rows}), "ba": len({r[:2] for r in rows}), "c": 50,
        "high": 9, "unknown": sum((r[0] or 0) > 1 for r in rows),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    assert set(profiling.tallies(df.limit(0), {"a": ["a"]}, {"x": F.col("c") > 1}).first()) == {0}


def test_versions_kept_up_to_date_are_those_of_a_rebuild(spark, tmp_path):
    rng = random.Random(8)
    rows = [(f"k{rng.randrange(30)}", f"2015-01-{1 + i // 20:02d}", i, rng.choice([1, 1, 1, 2, None]))
            for i in range(200)]
    df = spark.createDataFrame(rows, "k string, d string, n int, v int").withColumn("d", F.col("d").cast("date"))
    table = history.VersionTable(spark, str(tmp_path), "k", ["v"], buckets=4)
    assert table.read() is None and table.apply(df.limit(0), "d", "n") == []
    days = sorted({r[1] for r in rows})
    for i, day in enumerate(days):
        table.apply(df.filter(F.col("d") == F.lit(day)), "d", "n")
        want = history.versions(df.filter(F.col("d") <= F.lit(day)), "k", "d", ["v"], "n")
        got = table.read().select(want.columns)
        if i % 4 == 1 or day == days[-1]:
            assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="has been observed"):
        table.apply(df.filter("d = '2015-01-03'"), "d", "n")

    def files():
        return {f for f in table.read().inputFiles()}

    before = files()
    same = table.read().filter("is_current").limit(1).select("k", "v").first()
    later = spark.createDataFrame([(same.k, same.v, 1), ("new", 5, 2)], "k string, v int, n int")
    changed = table.apply(later.withColumn("d", F.lit("2015-02-01").cast("date")), "d", "n")
    assert len(changed) == 1  # the other key is as it was
    kept = {f for f in before if f"bucket={changed[0]}/" not in f}
    assert kept and kept <= files()


def test_ended_versions_are_not_written_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "MERGED_FOLDERS", 3)
    table = history.VersionTable(spark, str(tmp_path), "k", ["v"], buckets=1)
    rows, folders = [], []
    for i in range(8):
        rows.append(("k", f"2015-01-{i + 1:02d}", i, i))
        df = spark.createDataFrame(rows, "k string, d string, n int, v int").withColumn("d", F.col("d").cast("date"))
        table.apply(df.filter(F.col("n") == i), "d", "n")
        written = spark.read.parquet(table._manifest()[1][0][-1]).count()
        folders.append((written, len(table._manifest()[1][0])))
        want = history.versions(df, "k", "d", ["v"], "n")
        assert Counter(table.read().select(want.columns).collect()) == Counter(want.collect())
    # the current version and the one that ended; all of them where the folders are put together
    assert folders == [(1, 1), (2, 2), (2, 3), (4, 1), (2, 2), (2, 3), (7, 1), (2, 2)]
