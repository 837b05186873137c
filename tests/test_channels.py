import pytest
from pyspark.sql import functions as F

from clickledger.plans.channels import channel_classify, channel_prep, channel_seed_rows
from clickledger.plans.sessions import DIRECT
from clickledger.plans.spend import sheet_spend_prep
from clickledger.rules.cities import CITY_WORDS, city_of, city_style

from .conftest import make_events, rows, values

CLICKS = (
    "gcl_id string, date date, account_id string, campaign_id string, campaign_name string, "
    "ad_group_id string, ad_group_name string, ad_network_type1 string, keyword_match_type string"
)
MAP = (
    "marketing_string_id string, marketing_string_rank int, join_id string, account_id string, "
    "campaign_id string, ad_group_id string, campaign string"
)


def classify(spark, **fields):
    events = make_events(spark, {"at": "2024-01-10 10:00:00", "refr_medium": None, **fields})
    clicks, known = spark.createDataFrame([], CLICKS), spark.createDataFrame([], MAP)
    return rows(channel_classify(channel_prep(events, clicks, known)))[0]


@pytest.mark.parametrize(
    "fields, subchannel, channel",
    [
        ({"mkt_campaign": "crm_de_a_b_partner", "mkt_medium": "transactional"}, "transactional partner email", "crm"),
        ({"refr_medium": "email", "mkt_medium": "transactional"}, "transactional customer email", "crm"),
        ({"mkt_campaign": "xcrmy"}, "marketing email", "crm"),  # '_' stands for any character
        ({"refr_medium": "email"}, "email", "crm"),
        ({"mkt_source": "google", "mkt_medium": "dis", "mkt_campaign": "x_de_y_remarketing"}, "display remarketing google", "display remarketing"),
        ({"mkt_source": "google", "mkt_medium": "dis", "mkt_campaign": "x_de_y_z_smart"}, "display smart google", "unknown"),
        ({"mkt_source": "google", "mkt_medium": "cpc", "mkt_campaign": "b_x"}, "paid brand google", "brand"),
        ({"mkt_campaign": "gaw_de_painting"}, "paid search google", "paid search"),
        ({"mkt_campaign": "de_ba_x"}, "paid search bing", "paid search"),
        ({"mkt_campaign": "smt_de_x_retargeting"}, "display retargeting sociomantic", "display remarketing"),
        ({"refr_medium": "social"}, "social organic fcbk", "social organic"),
        ({"refr_medium": "search", "page_urlpath": "/"}, "organic brand", "brand"),
        ({"refr_medium": "search", "mkt_campaign": "summer"}, "uncaught search", "unknown"),
        ({"refr_medium": "search"}, "organic search", "organic search"),
        ({"mkt_source": "sms"}, "sms", "crm"),
        ({"page_urlpath": "/"}, "direct", "brand"),
        ({"mkt_medium": "odd"}, "uncaught utms", "unknown"),
        ({}, "referrer", "referrer"),
    ],
)
def test_ladder(spark, fields, subchannel, channel):
    got = classify(spark, **fields)
    assert (got["mkt_subchannel"], got["mkt_channel"]) == (subchannel, channel)


def test_long_and_empty_codes(spark):
    got = classify(spark, mkt_campaign="x" * 300, mkt_term="y" * 300, mkt_content="z" * 900)
    assert [len(got[c]) for c in ("campaign", "term", "content")] == [128, 128, 500]
    got = classify(spark, mkt_campaign="", mkt_source="")
    assert (got["campaign"], got["prefix"], got["product"], got["source"]) == ("", "", "na", "")


def test_click_report_overrides_the_url(spark):
    events = make_events(
        spark,
        {"at": "2024-01-10 10:00:00", "mkt_clickid": "c1", "mkt_campaign": "own", "mkt_source": "Bing"},
        {"at": "2024-01-11 10:00:00", "mkt_clickid": "c1", "mkt_campaign": "own", "mkt_source": "Bing"},
        {"at": "2024-01-11 10:00:00", "mkt_campaign": "own"},
    )
    clicks = spark.createDataFrame([("c1", None, "a", "b", "GAW_x", "g", "Group", "Search Network", "Exact")], CLICKS)
    clicks = clicks.withColumn("date", F.lit("2024-01-10").cast("date"))
    got = rows(channel_prep(events, clicks, spark.createDataFrame([], MAP)), "event_id")
    assert [(r["campaign"], r["medium"], r["mkt_source"]) for r in got] == [
        ("gaw_x", "cpc", "google"), ("own", "", "bing"), ("own", "", None),
    ]


def test_excluded_referrers(spark):
    hosts = ["eu6.salesforce.com", "www.google.de", None]
    events = make_events(spark, *[{"at": "2024-01-10 10:00:00", "refr_urlhost": h} for h in hosts],
                         {"at": "2024-01-10 10:00:00", "page_referrer": "https://www.paypal.com/x"})
    out = channel_prep(events, spark.createDataFrame([], CLICKS), spark.createDataFrame([], MAP))
    assert values(out, "event_id", "event_id") == ["e1", "e2"]


def test_cities(spark):
    codes = ["gaw_de_x_city-berlin", "gaw_x_hamburg_essen", "gaw_x_y", "gaw_city", "gaw_a_b_city-extended-x", "gaw_a_b_c_extended", "sp_berlin", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, c string")
    df = df.withColumn("style", city_style(F.col("c")))
    assert values(df, "style", "i") == ["city", "city", "non_city", "city", "extended", "extended", "na", "na"]
    cities = df.withColumn("city", city_of(F.col("c"), F.col("style")))
    # 'essen' stands before 'hamburg' in the list
    assert values(cities, "city", "i")[:4] == ["berlin", "essen", "na", "na"]
    assert len(CITY_WORDS) == 49


def test_seed_rows(spark):
    got = {r["utm_id"]: r for r in rows(channel_seed_rows(spark))}
    assert len(got) == 4
    assert got[DIRECT]["mkt_channel"] == "brand" and got[DIRECT]["mkt_subchannel"] == "direct"


def test_sheet_names(spark):
    sheet = spark.createDataFrame(
        [("bing", "paid search"), ("bing", "native"), ("smt", "retargeting"), ("flyer", "radio")],
        "source string, marketing_channel string",
    ).withColumns({"date": F.lit("2024-01-01").cast("date"), "month_spend": F.lit(1.0), "spend": F.lit(1.0)})
    got = values(sheet_spend_prep(sheet), "subchannel", "source", "channel")
    assert got == ["undefined", "paid search bing ", "undefined", "display retargeting sociomantic"]
