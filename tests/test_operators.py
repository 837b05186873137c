import math
import random

from pyspark.sql import functions as F

from clickledger.operators import loads
from clickledger.operators.chunked import carried_last, group_totals, running_count
from clickledger.operators.dedupe import one_per_key
from clickledger.operators.quantiles import group_quantiles
from clickledger.operators.skew import HotKeyRule, hot_keys, lookup, with_slices
from clickledger.plans.opportunities import pair_corr
from clickledger.plans.repairs import distinct_sum, hashed_distinct_sum
from clickledger.streaming.events import timeout_sessions

from .conftest import TINY, make_events, rows, same, ts, values


def numbers(spark, n=200):
    pick = random.Random(7)
    made = [
        (pick.choice("aab"), i, pick.choice([None, i]), i // 20, float(pick.randint(-50, 500)) / 4)
        for i in range(n)
    ]
    return spark.createDataFrame(made, "k string, o int, v int, c int, x double")


def test_chunked_windows_equal_plain_ones(spark):
    df = numbers(spark)
    keys, order = ["k"], ["o"]
    plain = running_count(df, keys, order, [], "r").withColumn("r", F.col("r").cast("long"))
    assert same(plain, running_count(df, keys, order, ["c"], "r"))
    for current in (True, False):
        for backward in (True, False):
            args = (F.col("v"), "l", current, backward)
            assert same(carried_last(df, keys, order, [], *args), carried_last(df, keys, order, ["c"], *args))
    total = {"t": F.col("o")}
    assert same(group_totals(df, keys, [], total), group_totals(df, keys, ["c"], total))


def test_hot_keys_and_slices(spark):
    df = spark.createDataFrame(
        [("hot", ts(f"2024-01-01 00:00:{i:02d}")) for i in range(20)] + [("cold", ts("2024-01-01 00:00:00"))],
        "k string, t timestamp",
    )
    hot = hot_keys(df, ["k"], "t", TINY)
    assert values(hot, "k") == ["hot"]
    sliced = with_slices(df, ["k"], "t", hot)
    assert {r["slice"] for r in rows(sliced) if r["k"] == "cold"} == {0}
    sizes = values(sliced.filter("k = 'hot'").groupBy("slice").count(), "count")
    assert sum(sizes) == 20 and max(sizes) <= 3
    assert hot_keys(df, ["k"], "t") is None


def test_a_burst_is_cut_by_rows_not_by_time(spark):
    """A third of all rows in one minute, and long stretches with hardly any."""
    times = [f"2024-01-01 00:00:30.{i:06d}" for i in range(300)] + [f"2024-{m:02d}-01 00:00:00" for m in range(2, 13)]
    df = spark.createDataFrame([("hot", ts(t)) for t in times], "k string, t timestamp")
    sliced = with_slices(df, ["k"], "t", hot_keys(df, ["k"], "t", HotKeyRule(max_rows=20)))
    assert max(values(sliced.groupBy("slice").count(), "count")) <= 25


def test_hot_plans_grow_by_a_step_each(spark):
    df, scans = numbers(spark), []
    for k in range(4):
        df = running_count(df, ["k"], ["o"], ["c"], f"n{k}")
        scans.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
    assert scans == scans[:1] * 4


def test_lookup_of_hot_and_missing_keys(spark):
    facts = spark.createDataFrame([(k, i) for i, k in enumerate("aaaaabc")] + [(None, 99)], "k string, n int")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("d", 3)], "k string, w int")
    plain = facts.join(table, "k", "left")
    assert same(plain, lookup(facts, table, ["k"]))
    assert same(facts.join(table, "k"), lookup(facts, table, ["k"], "inner"))


def test_one_per_key_limits_before_the_shuffle(spark):
    df = one_per_key(numbers(spark), ["k"], [F.col("o").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert values(df, "o", "k") == [max(r["o"] for r in rows(numbers(spark)) if r["k"] == k) for k in "ab"]


def test_group_quantiles_as_percentiles(spark):
    df = numbers(spark).withColumn("x", F.when(F.col("o") % 7 != 0, F.col("x")))
    spec = {"q1": (F.col("x"), 0.25), "med": (F.col("x"), 0.5), "v9": (F.col("v"), 0.9)}
    for keys in (["k"], []):
        own = [F.percentile(v.cast("double"), p).alias(n) for n, (v, p) in spec.items()]
        plain, big = rows(df.groupBy(*keys).agg(*own), *keys), rows(group_quantiles(df, keys, spec), *keys)
        assert len(plain) == len(big)
        for a, b in zip(plain, big):
            assert all(math.isclose(a[n], b[n], abs_tol=1e-9) for n in spec)


def test_quantiles_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0)], "k string, x double")
    got = rows(group_quantiles(df, ["k"], {"m": (F.col("x"), 0.5)}), "k")
    assert [r["m"] for r in got] == [1.5, 5.0]


def test_load_patterns(spark):
    schema = "k string, t int, kind string, note string"
    target = spark.createDataFrame([("a", 1, "x", "old"), ("b", 5, "y", "old"), (None, 9, None, "old")], schema)
    stage = spark.createDataFrame([("b", 4, "x"), ("c", 6, "x"), (None, 7, "x")], "k string, t int, kind string")
    empty = stage.limit(0)

    upserted = loads.upsert_by_key(target, stage, "k")
    assert sorted(map(str, values(upserted, "k"))) == ["None", "None", "a", "b", "c"]
    assert same(loads.upsert_by_key(loads.upsert_by_key(target, stage.dropna(), "k"), stage.dropna(), "k"),
                loads.upsert_by_key(target, stage.dropna(), "k"))
    assert same(loads.upsert_by_key(target, empty, "k"), target)

    assert sorted(values(loads.replace_tail(target, stage, "t"), "t")) == [1, 4, 6, 7]
    assert same(loads.replace_tail(target, empty, "t"), target)

    assert sorted(values(loads.replace_slice(target, stage, "kind", "x"), "t")) == [4, 5, 6, 7, 9]
    assert sorted(values(loads.replace_slice(target, stage, "kind", "x", since="t"), "t")) == [1, 4, 5, 6, 7, 9]
    assert same(loads.replace_slice(target, empty, "kind", "x", since="t"), target)

    assert sorted(values(loads.append_unseen(target, stage, "k"), "t")) == [1, 5, 6, 9]
    assert [r["note"] for r in rows(loads.partial_insert(target, stage), "t")].count(None) == 3


def test_window_bounds(spark):
    log = spark.createDataFrame([(ts("2024-02-01 00:00:00"), "events_start")], "logged_at timestamp, job_title string")
    target = spark.createDataFrame([(ts("2024-01-10 15:00:00"),)], "t timestamp")
    start, end = loads.window_bounds(target, "t", log, "events_start")
    got = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    assert (got.s, got.e) == (ts("2024-01-09 23:00:00"), ts("2024-02-01 00:00:00"))
    start, _ = loads.window_bounds(target.limit(0), "t", log, "events_start")
    assert spark.range(1).select(start.alias("s")).first().s == ts("1969-12-31 23:00:00")


def test_distinct_sums_survive_fan_out(spark):
    made = [("g", "k1", 10.5)] * 3 + [("g", "k2", 10.5), ("h", "k1", 1.0)]
    df = spark.createDataFrame(made, "g string, k string, v double")
    for how in (distinct_sum, hashed_distinct_sum):
        assert values(how(df, ["g"], "v", "k"), "total", "g") == [21.0, 1.0]


def test_correlation_of_constants_is_null(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "x int, y int")
    assert pair_corr(df, "x", "y").first().corr is None


def test_timeout_sessions_of_hot_users(spark):
    minutes = [0, 10, 39, 70, 100, 131, 140]
    events = make_events(spark, *[{"at": f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"} for m in minutes])
    plain = timeout_sessions(events)
    assert values(plain, "events", "start_at") == [3, 2, 2]
    assert same(plain, timeout_sessions(events, TINY))
