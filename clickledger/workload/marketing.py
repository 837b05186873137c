from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import one_per_key
from ..operators.loads import upsert_by_key
from ..plans import adgroups, channels, conversions, returns, sessions, spend
from ..rules import channels as rules
from ..rules.cities import city_of
from ..rules.measures import MEASURES
from .registry import Tables, query


def session_map(t: Tables) -> DataFrame:
    return sessions.sessionize(t.web_events)


def bounds(t: Tables) -> DataFrame:
    return sessions.session_bounds(t.step("session_map", session_map), t.web_events)


def adgroup_map(t: Tables) -> DataFrame:
    return t.step("adgroup_map", lambda t: adgroups.adgroup_utm_map(t.click_report, t.web_events))


def prepared(t: Tables) -> DataFrame:
    return channels.channel_prep(t.web_events, t.click_report, adgroup_map(t))


def session_facts(t: Tables, details: bool = True) -> DataFrame:
    return sessions.session_facts(
        bounds(t),
        t.step("prepared", prepared),
        t.tv_peaks,
        t.iso_country_codes,
        t.user_map,
        t.utm_ids,
        events=t.web_events,
        details=details,
    )


def visits(t: Tables) -> DataFrame:
    """The session facts as later jobs read them, without the wide columns that none of them takes."""
    return t.step(
        "session_facts", lambda t: session_facts(t, details=False).drop("landing_page_url", "landing_page_title")
    )


def load_end(t: Tables):
    return t.load_log.filter("runner_title = 'events' AND position_type = 0").select(
        F.max("logged_at")
    ).scalar()


def onsite(t: Tables) -> DataFrame:
    return conversions.onsite_conversions(
        t.web_events, t.step("session_map", session_map), t.valid_leads, load_end(t)
    )


def paths(t: Tables) -> DataFrame:
    return conversions.conversion_path(t.step("onsite", onsite), visits(t))


def lead_summary(t: Tables) -> DataFrame:
    placed = t.step("onsite", onsite).select(
        F.col("tr_orderid").try_cast("long").alias("lead_id"), "conversion_path_id"
    )
    return t.lead_measures.join(placed, "lead_id", "left").withColumn(
        "lead_created_did", F.unix_date(F.to_date("lead_created_at"))
    )


def attributed(t: Tables) -> DataFrame:
    return returns.attributed_return(lead_summary(t), t.step("paths", paths), visits(t))


def ad_spend(t: Tables) -> DataFrame:
    return spend.ad_spend(t.adset_report, t.adgroup_report, adgroup_map(t))


def channel_dimension(t: Tables) -> DataFrame:
    return channels.channel_dimension(t.step("prepared", prepared))


def _rounded(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("sessionize", "session_map")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_map(Tables(spark, sf_dir))


@query("session_bounds", "bounds")
def _(spark, sf_dir):
    return bounds(Tables(spark, sf_dir))


@query("session_bounds_copies", "bounds_of_copies")
def _(spark, sf_dir):
    """Bounds where rows of one identity repeat, as they are or as another kind of event."""
    t = Tables(spark, sf_dir)
    number = F.col("event_id").cast("int") % 20
    other = F.when(F.col("event") == "page_view", "transaction").otherwise("page_view")
    events = (
        t.web_events.unionByName(t.web_events.filter(number == 3))
        .unionByName(t.web_events.filter(number == 7).withColumn("event", other))
    )
    return sessions.session_bounds(t.step("session_map", session_map), events)


@query("session_facts", "facts_of_sessions")
def _(spark, sf_dir):
    return session_facts(Tables(spark, sf_dir))


@query("bot_filter", "bot_filter")
def _(spark, sf_dir):
    events = Tables(spark, sf_dir).web_events
    return sessions.countable_events(events).select(
        "event_id", "event", "app_id", "br_renderengine"
    )


@query("event_identity_join", "event_identity")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    raw = t.web_events.select(*sessions.IDENTITY, "event", "value")
    return session_map(t).join(raw, sessions.IDENTITY, "left").select(
        "session_id", "event_id", "collector_tstamp", "event", "value"
    )


@query("tv_peak_join", "tv_peak")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    hits = t.web_events.withColumn("minute", F.date_trunc("minute", "collector_tstamp"))
    return hits.join(t.tv_peaks, "minute", "left").select("event_id", "collector_tstamp", "utm_id")


@query("latest_per_key", "latest")
def _(spark, sf_dir):
    events = Tables(spark, sf_dir).web_events.filter(F.col("domain_userid").isNotNull())
    return one_per_key(
        events, ["domain_userid"], [F.col("collector_tstamp").desc(), F.col("event_id").asc()]
    ).select("domain_userid", "event_id", "collector_tstamp", "event")


@query("semi_filter", "valid_orders")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    known = t.valid_leads.select(F.col("lead_id").cast("string").alias("tr_orderid"))
    return t.web_events.join(known, "tr_orderid", "left_semi").select(
        "event_id", "tr_orderid", "value"
    )


@query("referrer_filter", "referred")
def _(spark, sf_dir):
    events = Tables(spark, sf_dir).web_events
    return events.filter(
        rules.counts_as_referral(F.col("refr_urlhost"), F.col("page_referrer"))
    ).select("event_id", "refr_urlhost", "page_referrer")


@query("click_match", "clicks_text")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return adgroups.click_match(t.click_report, t.web_events).select(
        "gcl_id", "ad_group_id", F.col("date").cast("string"), "event_id", "collector_tstamp"
    )


@query("adgroup_utm_map", "adgroups_text")
def _(spark, sf_dir):
    return adgroup_map(Tables(spark, sf_dir)).withColumn("click_date", F.col("click_date").cast("string"))


@query("last_nonnull", "last_values")
def _(spark, sf_dir):
    return adgroup_map(Tables(spark, sf_dir)).select(
        "ad_group_id", "source", "medium", "campaign", "term", "content"
    ).distinct()


@query("channel_prep", "prepared_channels")
def _(spark, sf_dir):
    return prepared(Tables(spark, sf_dir))


@query("campaign_decode", "decoded_channels")
def _(spark, sf_dir):
    return channels.campaign_decode(channels.latest_per_utm(prepared(Tables(spark, sf_dir))))


@query("city_style", "city_styles_only")
def _(spark, sf_dir):
    return prepared(Tables(spark, sf_dir)).select("event_id", "campaign", "city_style")


@query("city_extract", "city_styles")
def _(spark, sf_dir):
    return prepared(Tables(spark, sf_dir)).select(
        "event_id",
        "campaign",
        "city_style",
        city_of(F.col("campaign"), F.col("city_style")).alias("city"),
    )


@query("channel_rules", "channel_labels")
def _(spark, sf_dir):
    return channels.channel_classify(prepared(Tables(spark, sf_dir))).select(
        "utm_id", "mkt_subchannel", "mkt_channel", "channel", "product"
    )


@query("channel_classify", "classified_channels")
def _(spark, sf_dir):
    return channels.channel_classify(prepared(Tables(spark, sf_dir)))


@query("channel_seed_rows", "channel_dim")
def _(spark, sf_dir):
    return channel_dimension(Tables(spark, sf_dir))


@query("onsite_conversions", "conversions")
def _(spark, sf_dir):
    return onsite(Tables(spark, sf_dir))


@query("conversion_path", "path_places")
def _(spark, sf_dir):
    return paths(Tables(spark, sf_dir)).select(
        "conversion_path_id", "conversion_type", "session_id", "domain_userid", "path_position", "path_length"
    )


@query("attribution_weights", "paths")
def _(spark, sf_dir):
    return paths(Tables(spark, sf_dir))


@query("attributed_return", "returns")
def _(spark, sf_dir):
    values = ["cost", *MEASURES, *[f"lc_{m}" for m in MEASURES]]
    return _rounded(attributed(Tables(spark, sf_dir)), values, 6)


@query("return_facts", "returns_in_facts")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    values = ["cost", *MEASURES, *[f"lc_{m}" for m in MEASURES]]
    return _rounded(returns.return_facts(attributed(t), channel_dimension(t)), values, 6)


@query("ad_spend", "spend_text")
def _(spark, sf_dir):
    rows = ad_spend(Tables(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))
    return _rounded(rows, ["cost"], 4)


@query("spend_rollup", "spend_by_source")
def _(spark, sf_dir):
    return (
        ad_spend(Tables(spark, sf_dir))
        .groupBy("geo_id", "source", F.col("date").cast("string").alias("date"))
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.round(F.sum("cost"), 4).alias("cost"),
        )
    )


@query("spend_facts", "spend_in_facts")
def _(spark, sf_dir):
    rows = ad_spend(Tables(spark, sf_dir))
    facts = spend.spend_facts(rows, channels.channel_classify(rows))
    return _rounded(facts, ["cost"], 4)


def sheet_facts(t: Tables) -> DataFrame:
    rows = spend.sheet_spend_prep(t.sheet_spend)
    keys = spend.sheet_channels(rows).select(
        "utm_id",
        F.lit(None).cast("long").alias("vertical_type_id"),
        F.lit(None).cast("long").alias("pbi_utm_id"),
    )
    return spend.manual_spend(rows, keys)


@query("manual_spend", "sheet_in_facts")
def _(spark, sf_dir):
    return sheet_facts(Tables(spark, sf_dir))


@query("partial_insert", "channels_with_sheet")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    sheet = spend.sheet_channels(spend.sheet_spend_prep(t.sheet_spend))
    return upsert_by_key(channel_dimension(t), sheet, "utm_id").select(
        "utm_id", "channel", "mkt_channel", "mkt_subchannel", "source", "product", "updated_at"
    )
