from pyspark.sql import functions as F

from clickledger.plans.sessions import session_bounds, sessionize

from .conftest import TINY, make_events, rows, same, values


def sessions_of(spark, *given):
    return values(sessionize(make_events(spark, *given)), "session_id", "derived_ranking")


def at(time, **fields):
    return {"at": f"2024-01-10 {time}", **fields}


def test_internal_referrer_stays_in_session(spark):
    assert sessions_of(spark, at("10:00"), at("10:01"), at("10:02")) == ["20240110_e0"] * 3


def test_new_entrance_splits_and_repeated_entrance_does_not(spark):
    outside = {"refr_medium": "search", "page_referrer": "https://g.com/"}
    other = {"refr_medium": "search", "page_referrer": "https://b.com/"}
    got = sessions_of(
        spark, at("10:00", **outside), at("10:01"), at("10:02", **outside), at("10:03", **other), at("10:04")
    )
    assert got == ["20240110_e0"] * 3 + ["20240110_e3"] * 2


def test_null_referrer_medium_is_an_entrance(spark):
    got = sessions_of(spark, at("10:00"), at("10:01", refr_medium=None))
    assert got == ["20240110_e0", "20240110_e1"]


def test_tracker_session_and_berlin_day_split(spark):
    got = sessions_of(spark, at("10:00"), at("10:40", domain_sessionid="t"))
    assert got == ["20240110_e0", "20240110_e1"]
    # 23:00 UTC is midnight in Berlin in winter, 22:00 UTC in summer
    got = sessions_of(spark, at("22:59:59"), at("23:00:00"))
    assert got == ["20240110_e0", "20240111_e1"]
    got = sessions_of(spark, {"at": "2024-06-10 21:59:59"}, {"at": "2024-06-10 22:00:00"})
    assert got == ["20240610_e0", "20240611_e1"]


def test_returning_tracker_session_does_not_split_again(spark):
    got = sessions_of(
        spark, at("10:00"), at("10:01", domain_sessionid="t"), at("10:02"), at("10:03", domain_sessionid="t")
    )
    assert got == ["20240110_e0"] + ["20240110_e1"] * 3


def test_copies_keep_the_newest_and_leave_a_gap(spark):
    copy = {"event_id": "x"}
    got = rows(
        sessionize(make_events(spark, at("10:00"), at("10:01", **copy), at("10:02", **copy), at("10:03"))),
        "derived_ranking",
    )
    assert [(r["event_id"], r["derived_ranking"], r["session_event_index"]) for r in got] == [
        ("e0", 1, 1),
        ("x", 3, 2),
        ("e3", 4, 3),
    ]


def test_equal_times_are_ordered_by_id(spark):
    got = rows(sessionize(make_events(spark, *[at("10:00", event_id=i) for i in "cab"])), "derived_ranking")
    assert [r["event_id"] for r in got] == ["a", "b", "c"]


def test_unwanted_events(spark):
    kept = sessionize(
        make_events(
            spark,
            at("10:00", br_renderengine="bot"),
            at("10:01", br_renderengine=None),
            at("10:02", app_id="web-internal"),
            at("10:03", app_id=None),
            at("10:04", domain_userid=None),
        )
    )
    assert values(kept, "event_id", "event_id") == ["e1", "e3"]


def busy_events(spark):
    given = []
    for i in range(60):
        given.append(
            {
                "at": f"2024-01-{10 + i % 3:02d} {8 + (i * 7) % 12:02d}:{(i * 13) % 60:02d}:00",
                "event_id": f"e{i % 55}",
                "domain_userid": "u" if i % 4 else "v",
                "domain_sessionid": f"s{i % 5}",
                "refr_medium": [None, "internal", "search"][i % 3],
                "page_referrer": f"r{i % 2}",
            }
        )
    # exact copies, which share their time
    return make_events(spark, *given, *[given[40]] * 7, given[41])


def test_hot_users_give_the_same_sessions(spark):
    events = busy_events(spark)
    assert same(sessionize(events), sessionize(events, rule=TINY))


def test_every_event_has_one_session(spark):
    out = sessionize(busy_events(spark))
    assert out.count() == out.select("event_id", "event_fingerprint").distinct().count() == 55
    assert out.filter(F.col("session_id").isNull()).count() == 0


def test_bounds_count_exact_copies(spark):
    view = at("10:00", event_id="x")
    events = make_events(spark, view, view, view, at("10:01", event="click"))
    got = rows(session_bounds(sessionize(events), events, landing=["page_url"]))
    assert [(r["events"], r["page_views"], r["page_url"]) for r in got] == [(4, 3, "https://x.com/")]


def test_bounds(spark):
    events = make_events(
        spark, at("10:00"), at("10:01", event="transaction"), at("10:05", event="click"), at("11:00", refr_medium=None)
    )
    got = rows(session_bounds(sessionize(events), events), "session_id")
    first = got[0]
    assert (first["start_event_id"], first["end_event_id"]) == ("e0", "e2")
    assert (first["events"], first["transactions"], first["page_views"]) == (3, 1, 1)
    assert len(got) == 2
    # bounds are exclusive
    cut = session_bounds(
        sessionize(events), events, F.lit("2024-01-10 10:00:00").cast("timestamp"), F.lit("2024-01-10 11:00:00").cast("timestamp")
    )
    assert [r["events"] for r in rows(cut)] == [2]


def test_copies_of_several_users_and_days(spark):
    def copy(time, user, **fields):
        return {"at": f"2024-01-{time}", "event_id": "x", "domain_userid": user, **fields}

    events = make_events(
        spark,
        # one time, two users: the one for whom it comes later among all events has it
        {"at": "2024-01-09 08:00", "domain_userid": "a"},
        {"at": "2024-01-09 08:01", "domain_userid": "a"},
        *[copy("10 10:00", user) for user in "aab"],
        {"at": "2024-01-10 10:01", "domain_userid": "b"},
        # one user, two days
        *[{"at": f"2024-01-{day} 09:00", "event_id": "y", "domain_userid": "c"} for day in (11, 12, 12)],
    )
    got = sessionize(events)
    assert same(got, sessionize(events, rule=TINY))
    kept = {r["event_id"]: (r["domain_userid"], r["derived_ranking"]) for r in rows(got)}
    assert kept["x"] == ("a", 4) and kept["y"] == ("c", 3) and len(kept) == 5


def test_rows_are_not_sent_by_event(spark):
    plan = sessionize(busy_events(spark))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(domain_userid" in plan and "hashpartitioning(event_id" not in plan
