from datetime import date

from pyspark.sql import functions as F

from clickledger.plans import dimensions, features, leads, opportunities, profile
from clickledger.plans.models import with_folds

from .conftest import make_events, rows, same, ts, values  # noqa: F401

LEADS = (
    "id string, backend_opportunity_id string, owner_id string, source string, lead_campaign string, "
    "mkt_source string, mkt_medium string, mkt_campaign string, status string, substatus string, "
    "salutation string, country string, city string, job_country string, job_city string, "
    "postal_code string, job_postal_code string, record_type_id string, main_vertical string, "
    "created_date timestamp, last_modified_date timestamp, lead_process_end timestamp, "
    "call_1_timestamp timestamp, score double, price double, is_trainings_lead boolean"
)
OFFERS = "sf_lead_id string, sf_opportunity_id string, sf_offer_id string, hb_lead_id long, qualified_at timestamp"
OPPS = (
    "id string, sales_agent_lookup string, created_date timestamp, opscancellationreason string, job_country string"
)
CONVERSIONS = (
    "tr_orderid string, session_id string, conversion_type string, conversion_path_id string, "
    "onsite_conversion_locale_tstamp timestamp, domain_userid string, onsite_user_id string"
)


def lead_rows(spark, given, offers=(), opps=(), touches=()):
    names = [p.split()[0] for p in LEADS.split(", ")]
    plain = {
        "owner_id": "owner", "status": "Open", "record_type_id": "x", "is_trainings_lead": False,
        "main_vertical": "painting", "created_date": ts("2024-01-01 00:00:00"),
        "last_modified_date": ts("2024-01-02 00:00:00"),
    }
    made = [tuple({**dict.fromkeys(names), **plain, **g}[n] for n in names) for g in given]
    return leads.lead_dim(
        spark.createDataFrame(made, LEADS),
        spark.createDataFrame(list(offers), OFFERS),
        spark.createDataFrame(list(opps), OPPS),
        spark.createDataFrame(list(touches), "lead_id long, agent_id string, lead_touchpoint_at timestamp"),
        spark.createDataFrame([("Germany", "de")], "leads_country string, opportunities_country string"),
        spark.createDataFrame([], CONVERSIONS),
        spark.createDataFrame([], "session_id string, landing_pagepath string"),
        ts("2024-02-01 00:00:00"),
    )


def test_earliest_offer_wins_and_missing_times_come_last(spark):
    given = [{"id": "L1", "backend_opportunity_id": "1"}, {"id": "L2", "backend_opportunity_id": "7"}]
    offers = [
        ("L1", "O1", "F1", 5, None),
        ("L1", "O2", "F2", 6, ts("2024-01-05 00:00:00")),
        ("L1", "O3", "F3", 7, ts("2024-01-03 00:00:00")),
    ]
    got = rows(lead_rows(spark, given, offers), "lead_id")
    # lead 7 also exists without an offer, which ranks behind the qualified one
    assert [(r["lead_id"], r["sf_lead_id"], r["associated_opportunities_count"]) for r in got] == [(7, "L1", 3)]
    assert got[0]["has_opportunity"] == 1


def test_lead_states(spark):
    given = [
        {"id": "A", "backend_opportunity_id": "1", "status": "1st Call", "substatus": "Wrong data: x"},
        {"id": "B", "backend_opportunity_id": "2", "status": "Dublicate", "source": "HouseBrand"},
        {"id": "C", "backend_opportunity_id": "3", "status": "Unqualified", "substatus": "ok", "country": "Germany",
         "job_city": " Bonn", "postal_code": "12-3 A"},
        {"id": "D", "backend_opportunity_id": "4", "is_trainings_lead": True},
        {"id": "E", "backend_opportunity_id": "5", "record_type_id": "record-partner-lead"},
        {"id": "F", "backend_opportunity_id": None},
    ]
    got = rows(lead_rows(spark, given), "lead_id")
    assert [r["lead_id"] for r in got] == [1, 2, 3]
    assert [r["status"] for r in got] == ["in progress", "duplicate", "unqualified"]
    assert [r["is_valid_lead"] for r in got] == [False, True, True]
    assert [r["is_reached_lead"] for r in got] == [True, True, False]
    assert [r["is_internal_lead"] for r in got] == [0, 1, 0]
    assert (got[2]["geo_id"], got[2]["zip_id"]) == ("de bonn", "de123a")
    assert got[2]["lead_closed_at"] == ts("2024-01-02 00:00:00") and got[0]["lead_closed_at"] is None


def test_agents_ignore_the_queue(spark):
    touches = [
        (1, "lead-queue", ts("2024-01-01 00:00:00")),
        (1, "a", ts("2024-01-02 00:00:00")),
        (1, "b", ts("2024-01-03 00:00:00")),
    ]
    got = rows(lead_rows(spark, [{"id": "A", "backend_opportunity_id": "1"}], touches=touches))[0]
    assert (got["first_agent_id"], got["last_agent_id"]) == ("a", "b")
    assert got["first_touchpoint_at"] == ts("2024-01-02 00:00:00")


def test_vertical_and_geo_dimensions(spark):
    verticals = spark.createDataFrame([(100, "painting", 1)], "id int, name string, area_type_id int")
    seen = spark.createDataFrame([("varnish",), ("paint",), ("painting",), (None,)], "p string")
    got = {r["vertical_type_id"]: r for r in rows(dimensions.vertical_dim(verticals, [seen])) if r["vertical_type_id"]}
    assert {1000, 1001, 1002, 1003, 1, 2} < set(got)
    # 'paint' and 'painting' share the code of their first four letters; the shorter name stays
    assert got[5271844]["vertical"] == "paint" and got[5271844]["surface_type"] == "wall"
    feed = spark.createDataFrame([("DE ", " Berlin"), ("de", "berlin"), (None, None)], "c string, t string")
    feed = feed.select(*dimensions.geo_feed(F.col("c"), F.col("t")))
    geo = dimensions.geo_dim([feed, feed])
    assert values(geo, "geo_id", "geo_id") == ["", "deberlin", "na"]
    assert values(dimensions.geo_dim([feed], geo.filter("geo_id = ''")), "geo_id") == ["deberlin"]


STUDY = (
    "opportunity_id string, city_bucket string, partner_status string, bin_won_opp boolean, bin_prepared boolean, "
    "bin_upsold boolean, bin_cancelled boolean, bin_completed boolean, bin_invoiced boolean, nmv double, "
    "inv_margin double, net_inv_amount double, last_close2cancel int, book2cancel int, sale_period int, "
    "close2book int, no_partner int, partner_problem int, wish_start date"
)


def study(spark, n=40):
    made = []
    for i in range(n):
        gone = i % 3 == 0
        made.append(
            (str(i), f"c{i % 4}" if i % 10 else None, ["x", "y"][i % 2], i % 7 != 0, i % 2 == 0, i % 5 == 0, gone,
             not gone, not gone, 100.0 + i * 1.25, i / 100, 90.0 + i, i if gone else None, i // 2 if gone else None,
             i % 9, i % 6, int(i % 6 == 0), 0, date(2024, 1, 1))
        )
    return spark.createDataFrame(made, STUDY)


def test_profile_keeps_every_group(spark):
    total = profile.profile(study(spark), "city_bucket")
    assert sum(values(total, "n_jobs")) == 40 and total.filter("city_bucket IS NULL").count() == 1


def test_profile_year_and_minimum(spark):
    rows_ = study(spark)
    assert profile.profile(rows_, "city_bucket", as_of=date(2024, 2, 5)).count() == 5
    assert profile.profile(rows_, "city_bucket", as_of=date(2024, 2, 4)).count() == 0
    assert profile.profile(rows_, "city_bucket", min_jobs=9).filter("n_jobs <= 9").count() == 0


def test_vertical_combo_needs_five_percent(spark):
    sales = spark.createDataFrame(
        [("o", "b", 0.5), ("o", "a", 0.46), ("o", "c", 0.04), ("p", None, 1.0)],
        "opportunity_id string, vertical string, opportunity_part_ratio double",
    )
    assert [tuple(r.values()) for r in rows(opportunities.vertical_combo(sales))] == [("o", "a | b", 2)]


def test_clamp_and_scale(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    clamped = features.winsorize(df, ["x"])
    assert values(clamped, "x", "x") == [None, 1.0, 2.0, 3.0, 4.0, 7.0]
    scaled = values(features.zscore(clamped, ["x"]), "x", "x")
    assert len(scaled) == 5 and abs(sum(scaled)) < 1e-9


def test_information_gain_of_a_perfect_and_a_useless_feature(spark):
    df = spark.createDataFrame(
        [(i % 2, i % 2 == 0, (i // 2) % 2 == 0, float(i % 2)) for i in range(400)],
        "label int, good boolean, bad boolean, number double",
    )
    got = {r["feature"]: r for r in rows(features.information_gain(df, "label", ["good", "bad", "number"]))}
    assert abs(got["good"]["information_gain"] - 0.693147) < 1e-5 and abs(got["good"]["chi_squared"] - 1) < 1e-9
    assert abs(got["number"]["information_gain"] - 0.693147) < 1e-5
    assert abs(got["bad"]["information_gain"]) < 1e-9 and got["bad"]["chi_squared"] < 1e-6


def test_folds_are_stratified(spark):
    df = spark.range(103).select(
        F.col("id").cast("string").alias("opportunity_id"), (F.col("id") < 23).cast("int").alias("label")
    )
    sizes = rows(with_folds(df, 5).groupBy("label", "fold").count(), "label", "fold")
    assert [r["count"] for r in sizes] == [16] * 5 + [5, 5, 5, 4, 4]
