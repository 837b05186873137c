from pyspark.sql import functions as F

from clickledger.plans.conversions import conversion_path
from clickledger.plans.returns import attributed_return
from clickledger.plans.sessions import DIRECT
from clickledger.rules.measures import MEASURES

from .conftest import TINY, rows, same, ts

SESSION = "session_id string, domain_userid string, start_collector_tstamp timestamp, utm_id string"
CONVERSION = (
    "conversion_path_id string, conversion_type string, domain_userid string, session_id string, "
    "tr_orderid string, collector_tstamp timestamp"
)


def visits(spark, *days, direct=()):
    made = [
        (f"s{i}", "u", ts(f"2024-{d} 10:00:00"), DIRECT if i in direct else "ad") for i, d in enumerate(days)
    ]
    return spark.createDataFrame(made, SESSION)


def goals(spark, *given):
    made = [
        (f"LEAD-{s}", "LEAD", "u", s, order, ts(f"2024-{d} 10:30:00")) for s, d, order in given
    ]
    return spark.createDataFrame(made, CONVERSION)


def weights(df, column):
    return [r[column] for r in rows(df, "conversion_path_id", "path_position")]


def test_weights_by_path_length(spark):
    expected = {
        1: ([1.0], [1.0]),
        2: ([0.5, 0.5], [0.5, 0.5]),
        3: ([0.5, 0.0, 0.5], [0.4, 0.2, 0.4]),
        5: ([0.5, 0.0, 0.0, 0.0, 0.5], [0.4, 0.2 / 3, 0.2 / 3, 0.2 / 3, 0.4]),
    }
    for n, (ends, position) in expected.items():
        path = conversion_path(
            goals(spark, (f"s{n - 1}", f"01-{n:02d}", "1")),
            visits(spark, *[f"01-{i + 1:02d}" for i in range(n)]),
        )
        assert weights(path, "first_last") == ends
        assert weights(path, "position_based") == position
        assert weights(path, "linear") == [1 / n] * n
        assert weights(path, "first") == [1.0] + [0.0] * (n - 1)
        assert weights(path, "last") == [0.0] * (n - 1) + [1.0]
        assert abs(sum(weights(path, "custom")) - 1) < 1e-3


def test_direct_visits_earn_nothing_after_the_first(spark):
    days = ["01-01", "01-02", "01-03"]
    middle = conversion_path(goals(spark, ("s2", "01-03", "1")), visits(spark, *days, direct={1}))
    assert weights(middle, "custom") == [0.5, 0.0, 0.5]
    last = conversion_path(goals(spark, ("s2", "01-03", "1")), visits(spark, *days, direct={2}))
    assert weights(last, "custom") == [0.6667, 0.3333, 0.0]
    everywhere = conversion_path(goals(spark, ("s2", "01-03", "1")), visits(spark, *days, direct={0, 1, 2}))
    assert weights(everywhere, "custom") == [1.0, 0.0, 0.0]


def test_second_conversion_only_gets_what_came_after_the_first(spark):
    path = conversion_path(
        goals(spark, ("s1", "01-02", "1"), ("s3", "01-20", "2")),
        visits(spark, "01-01", "01-02", "01-10", "01-20", "01-30"),
    )
    got = [(r["conversion_path_id"], r["session_id"]) for r in rows(path, "session_id")]
    assert got == [("LEAD-s1", "s0"), ("LEAD-s1", "s1"), ("LEAD-s3", "s2"), ("LEAD-s3", "s3")]


def test_lookback_is_ninety_days_and_a_second(spark):
    visits_at = spark.createDataFrame(
        [("a", "u", ts("2024-01-01 10:29:59"), "x"), ("b", "u", ts("2024-01-01 10:30:00"), "x")], SESSION
    )
    path = conversion_path(goals(spark, ("z", "03-31", "1")), visits_at)
    assert [r["session_id"] for r in rows(path)] == ["b"]


def test_orders_of_one_session_share_the_path_of_the_first(spark):
    path = conversion_path(
        goals(spark, ("s0", "01-01", "1"), ("s0", "01-03", "2")), visits(spark, "01-01", "01-02")
    )
    assert [r["session_id"] for r in rows(path)] == ["s0"]


def busy(spark):
    days = [f"0{1 + i // 28}-{1 + i % 28:02d}" for i in range(56)]
    orders = [(f"s{i}", days[i], str(i)) for i in (3, 4, 20, 50)]
    return goals(spark, *orders), visits(spark, *days, direct=set(range(0, 56, 3)))


def test_hot_users_give_the_same_paths(spark):
    plain, hot = conversion_path(*busy(spark)), conversion_path(*busy(spark), rule=TINY)
    assert same(plain, hot)
    sums = hot.groupBy("conversion_path_id").agg(F.sum("custom").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-3 for r in rows(sums))


def test_returns_with_and_without_path(spark):
    conversions, sessions = busy(spark)
    paths = conversion_path(conversions, sessions)
    sessions = sessions.withColumns({"start_did": F.lit(1), "geo_id": F.lit("deberlin")})
    leads = spark.createDataFrame(
        [
            (1, ts("2024-01-01 00:00:00"), 10.0, 5, "own", "g", 0, "LEAD-s20"),
            (2, ts("2024-01-01 00:00:00"), 10.0, 5, "own", None, 0, None),
        ],
        "lead_id long, lead_created_at timestamp, lead_price double, primary_vertical_type_id long, "
        "utm_id string, geo_id string, lead_created_did int, conversion_path_id string",
    ).withColumns({m: F.lit(100.0) for m in MEASURES})
    out = attributed_return(leads, paths, sessions)
    sums = out.groupBy("lead_id").agg(
        *[F.sum(c).alias(c) for c in ("nmv", "lc_nmv", "cost")], F.count("*").alias("n")
    )
    first = rows(sums, "lead_id")[0]
    assert abs(first["nmv"] - 100) < 0.1 and first["lc_nmv"] == 100.0
    # the lead price is repeated for each session of the path
    assert first["cost"] == 10.0 * first["n"] and first["n"] == 16
    alone = rows(out.filter("lead_id = 2"))[0]
    assert (alone["utm_id"], alone["session_id"], alone["nmv"]) == ("own", "na", 100.0)


def test_landing_pages_looked_up_last_are_those_of_the_bounds(spark):
    from clickledger.plans import sessions
    from clickledger.workload import marketing
    from clickledger.workload.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    # the same rows as with bounds that bring the columns along
    inputs = [t.step("prepared", marketing.prepared), t.tv_peaks, t.iso_country_codes, t.user_map, t.utm_ids]
    mapped = t.step("session_map", marketing.session_map)
    brought = sessions.session_facts(sessions.session_bounds(mapped, t.web_events, landing=sessions.LANDING), *inputs)
    looked_up = marketing.session_facts(t)
    assert brought.exceptAll(looked_up).isEmpty() and looked_up.exceptAll(brought).isEmpty()


def test_returns_find_their_conversions_once(spark, tmp_path, monkeypatch):
    from clickledger.workload import marketing
    from clickledger.workload.registry import Tables

    kinds = ["view", "purchase", "click", "signup"]
    given = [(i, ts(f"2024-01-1{i % 5} 10:{i:02d}:00"), i % 3, kinds[i % 4], float(i), f'{{"k": {i}}}') for i in range(40)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/events.parquet")
    calls, onsite = [], marketing.onsite
    monkeypatch.setattr(marketing, "onsite", lambda t: calls.append(t) or onsite(t))
    t = Tables(spark, str(tmp_path))
    assert marketing.attributed(t).count() > 0
    assert len(calls) == 1
    assert not {"useragent", "landing_page_url"} & set(marketing.visits(t).columns)
