import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from clickledger.plans import channels, facts
from clickledger.plans import incremental as inc
from clickledger.plans.sessions import DETAILS, LANDING, session_bounds, session_facts, sessionize

from .conftest import make_events, rows, same, ts, values

KEEP = ["session_id", "event_id", "collector_tstamp", "session_event_index", "is_external"]


def store():
    return inc.Store(f"s_{uuid.uuid4().hex[:8]}", slots=3)


@pytest.fixture(scope="module")
def inputs(spark):
    clicks = spark.createDataFrame(
        [],
        "gcl_id string, date date, account_id string, campaign_id string, campaign_name string, ad_group_id string, "
        "ad_group_name string, ad_network_type1 string, keyword_match_type string",
    )
    adgroups = spark.createDataFrame(
        [],
        "marketing_string_id string, marketing_string_rank int, join_id string, account_id string, campaign_id string, "
        "ad_group_id string, campaign string",
    )
    peaks = spark.createDataFrame([], "minute timestamp, utm_id string")
    codes = spark.createDataFrame([("Germany", "DE")], "country string, iso_code string")
    users = spark.createDataFrame([("u", "b", "2"), ("u", "a", "1")], "domain_userid string, login_user_id string, onsite_user_id string")
    return inc.Inputs(clicks, adgroups, peaks, codes, users, spark.createDataFrame([], "utm_id string, id long"))


FIRST = [
    {"at": "2024-01-10 10:00:00", "event_id": "a", "geo_country": "Germany", "mkt_source": "x"},
    {"at": "2024-01-10 10:20:00", "event_id": "b"},
    {"at": "2024-01-11 10:00:00", "event_id": "c", "mkt_source": "x"},
    {"at": "2024-01-11 10:00:05", "event_id": "c", "mkt_source": "x"},
]
LATE = [
    {"at": "2024-01-10 10:10:00", "event_id": "d", "refr_medium": "search", "mkt_source": "x"},
    {"at": "2024-01-12 09:00:00", "event_id": "e", "mkt_source": "y"},
    # a copy on a later day takes its event along and leaves the 11th empty
    {"at": "2024-01-13 09:00:00", "event_id": "c", "mkt_source": "x"},
]
MORE = [
    # an older copy of an event that has moved on, and a newer one of another
    {"at": "2024-01-09 09:00:00", "event_id": "c", "mkt_source": "x"},
    {"at": "2024-01-14 09:00:00", "event_id": "a", "geo_country": "Germany", "mkt_source": "x"},
]


def assert_rebuilt(spark, at, inputs, events):
    table = spark.table(at.table("session_map"))
    mapped = sessionize(events)
    assert same(table.select(*KEEP), mapped.select(*KEEP))
    bounds = session_bounds(mapped, events, landing=LANDING)
    prepared = channels.channel_prep(events, inputs.clicks, inputs.adgroup_map)
    whole = session_facts(bounds, prepared, inputs.tv_peaks, inputs.iso_codes, inputs.users, inputs.utm_ids)
    assert same(spark.table(at.table("sessions")).drop("berlin_day"), whole)
    stored = spark.table(at.table("channel_prep")).drop("slot")
    assert same(channels.channel_classify(stored), channels.channel_classify(prepared))


def test_deliveries_end_like_one_rebuild(spark, inputs):
    at = store()
    for number, delivery in enumerate((FIRST, LATE, MORE)):
        inc.land(make_events(spark, *delivery), at, number)
        inc.run(spark, at, inputs)
    assert_rebuilt(spark, at, inputs, make_events(spark, *FIRST, *LATE, *MORE))
    days = values(spark.table(at.table("session_map")).select("berlin_day").distinct(), "berlin_day", "berlin_day")
    assert days == [date(2024, 1, d) for d in (10, 12, 13, 14)]
    # nothing new: nothing is touched
    before = spark.table(at.table("load_log")).count()
    inc.run(spark, at, inputs)
    assert spark.table(at.table("load_log")).count() == before


@pytest.mark.parametrize("cut_at", [1, 2])
def test_a_run_that_dies_before_a_mark_is_repeated(spark, inputs, monkeypatch, cut_at):
    at = store()
    inc.land(make_events(spark, *FIRST), at, 0)
    inc.run(spark, at, inputs)
    commit, calls = inc.commit, []

    def dying(*args, **kwargs):
        calls.append(args)
        if len(calls) == cut_at + 1:
            raise RuntimeError("lost")
        return commit(*args, **kwargs)

    monkeypatch.setattr(inc, "commit", dying)
    with pytest.raises(RuntimeError, match="lost"):
        inc.land(make_events(spark, *LATE), at, 1)
        inc.run(spark, at, inputs)
    monkeypatch.setattr(inc, "commit", commit)
    inc.land(make_events(spark, *LATE), at, 1)
    inc.run(spark, at, inputs)
    assert_rebuilt(spark, at, inputs, make_events(spark, *FIRST, *LATE))


def test_deliveries_that_wait_are_taken_together(spark, inputs):
    at = store()
    for number, delivery in enumerate((FIRST, LATE, MORE)):
        inc.land(make_events(spark, *delivery), at, number)
    inc.run(spark, at, inputs)
    assert_rebuilt(spark, at, inputs, make_events(spark, *FIRST, *LATE, *MORE))
    assert inc.marked(spark, at, inc.SESSIONS) == 2


def test_empty_deliveries_and_events_without_a_time(spark, inputs):
    at = store()
    nothing = make_events(spark, *FIRST).filter("false")
    inc.land(nothing, at, 0)
    inc.run(spark, at, inputs)
    untimed = make_events(spark, FIRST[0]).withColumn("collector_tstamp", F.lit(None).cast("timestamp"))
    inc.land(untimed, at, 1)
    inc.run(spark, at, inputs)
    inc.land(make_events(spark, *FIRST), at, 2)
    inc.run(spark, at, inputs)
    assert_rebuilt(spark, at, inputs, make_events(spark, *FIRST))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_run_reads_touched_days_and_slots_only(spark, inputs):
    at = store()
    inc.land(make_events(spark, *FIRST), at, 0)
    inc.run(spark, at, inputs)
    text = plan(inc.current_events(spark, at, [date(2024, 1, 10)]))
    stored = next(line for line in text.splitlines() if f"{at.name}_events" in line)
    assert "PartitionFilters: [" in stored and "berlin_day" in stored.split("PartitionFilters:")[1]
    assert "1 paths" in stored or "partition" in stored.lower()


# --- the marketing fact ---------------------------------------------------------------------------


def table_of_facts(spark):
    name = f"f_{uuid.uuid4().hex[:8]}"
    facts.create(spark, name)
    return name


def returns(spark, *given):
    made = [(ts("2024-01-01 00:00:00"), "lead", lead, day, cost) for lead, day, cost in given]
    return spark.createDataFrame(made, "event_at timestamp, fact_subtype string, lead_id long, date_id int, cost double")


def costs(spark, subtype, *given):
    return spark.createDataFrame([(subtype, day, c) for day, c in given], "fact_subtype string, date_id int, cost double")


def held(spark, name):
    return sorted((r["fact_subtype"], r["lead_id"] or 0, r["date_id"], r["cost"]) for r in rows(spark.table(name)))


def test_leads_that_move_to_another_month_leave_the_old_one(spark):
    name = table_of_facts(spark)
    facts.load_returns(returns(spark, (1, 10, 1.0), (2, 40, 2.0), (3, None, 3.0)), name)
    facts.load_returns(returns(spark, (1, 75, 5.0), (3, 41, 6.0)), name)
    assert held(spark, name) == [("lead", 1, 75, 5.0), ("lead", 2, 40, 2.0), ("lead", 3, 41, 6.0)]
    facts.load_costs(costs(spark, "mkt_spend", (20, 1.0), (45, 2.0), (70, 3.0)), name, facts.SPEND, tail_only=True)
    facts.load_costs(costs(spark, "mkt_spend", (47, 9.0)), name, facts.SPEND, tail_only=True)
    assert [r for r in held(spark, name) if r[0] == "mkt_spend"] == [("mkt_spend", 0, 20, 1.0), ("mkt_spend", 0, 45, 2.0), ("mkt_spend", 0, 47, 9.0)]


def test_facts_are_replaced_by_lead_day_and_kind(spark):
    name = table_of_facts(spark)
    facts.load_returns(returns(spark, (1, 10, 1.0), (1, 11, 2.0), (2, 10, 3.0), (3, 12, 4.0)), name)
    facts.load_costs(costs(spark, "mkt_spend", (10, 5.0), (11, 6.0), (12, 7.0)), name, facts.SPEND, tail_only=True)
    facts.load_costs(costs(spark, "mkt_spend_manual", (10, 8.0), (9, 9.0)), name, facts.SHEET)
    # lead 1 leaves the 11th, which only it had; lead 4 is new
    facts.load_returns(returns(spark, (1, 12, 10.0), (4, 13, 11.0)), name)
    facts.load_costs(costs(spark, "mkt_spend", (11, 60.0), (14, 70.0)), name, facts.SPEND, tail_only=True)
    facts.load_costs(costs(spark, "mkt_spend_manual", (10, 80.0)), name, facts.SHEET)
    want = [
        ("lead", 1, 12, 10.0), ("lead", 2, 10, 3.0), ("lead", 3, 12, 4.0), ("lead", 4, 13, 11.0),
        ("mkt_spend", 0, 10, 5.0), ("mkt_spend", 0, 11, 60.0), ("mkt_spend", 0, 14, 70.0),
        ("mkt_spend_manual", 0, 10, 80.0),
    ]
    assert held(spark, name) == want
    months = spark.table(name).select("fact_subtype", "fact_month").distinct().count()
    assert months == 3
    # again, and with empty stages
    facts.load_returns(returns(spark, (1, 12, 10.0), (4, 13, 11.0)), name)
    facts.load_returns(returns(spark, (1, 1, 1.0)).filter("false"), name)
    facts.load_costs(costs(spark, "mkt_spend", (1, 1.0)).filter("false"), name, facts.SPEND, tail_only=True)
    assert held(spark, name) == want
    facts.load_costs(costs(spark, "mkt_spend_manual", (1, 1.0)).filter("false"), name, facts.SHEET)
    assert held(spark, name) == want[:-1]


def test_the_report_reads_the_days_it_asks_for(spark):
    from clickledger.plans.report import cumulative_marketing

    name = table_of_facts(spark)
    day = (date(2024, 2, 1) - date(1970, 1, 1)).days
    facts.load_returns(returns(spark, *[(i, day - 30 * i, 1.0) for i in range(12)]), name)
    dates = spark.createDataFrame(facts.date_dimension(spark).collect(), facts.date_dimension(spark).schema)
    known = spark.createDataFrame([], "utm_id string, mkt_medium string, mkt_channel string")
    report = cumulative_marketing(spark.table(name).withColumn("event_at", F.lit(ts("2024-01-20 00:00:00"))), known, dates, date(2024, 2, 1))
    assert sorted(values(report, "date", "date"))[0] == date(2023, 12, 3) and report.count() == 3
    scan = next(line for line in plan(report).splitlines() if "PartitionFilters" in line)
    assert "dynamicpruning" in scan.split("PartitionFilters:")[1]


def test_days_are_written_once_and_channels_replace_themselves(spark, inputs, monkeypatch):
    at, aside = store(), []
    monkeypatch.setattr(inc, "written", lambda df, name, *rest, kept=inc.written: aside.append(name) or kept(df, name, *rest))
    for number, delivery in enumerate((FIRST, LATE, MORE)):
        inc.land(make_events(spark, *delivery), at, number)
        inc.run(spark, at, inputs)
    assert "days" not in aside and aside.count("channels") == 3
    assert_rebuilt(spark, at, inputs, make_events(spark, *FIRST, *LATE, *MORE))


def test_facts_without_details_are_the_same_otherwise(spark, inputs):
    # a second row of the first event differs in what is compared first and last
    events = make_events(spark, *FIRST, *LATE, {**FIRST[0], "page_url": "https://a.com/", "useragent": "z"}, {**FIRST[1], "useragent": "a"})
    bounds = session_bounds(sessionize(events), events)
    prepared = channels.channel_prep(events, inputs.clicks, inputs.adgroup_map)
    tables = (inputs.tv_peaks, inputs.iso_codes, inputs.users, inputs.utm_ids)
    whole = session_facts(bounds, prepared, *tables, events=events)
    short = session_facts(bounds, prepared, *tables, events=events, details=False)
    assert same(whole.drop(*DETAILS), short)
