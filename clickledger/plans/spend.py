"""Advertising cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lower_not_null, to_did
from ..operators.skew import lookup
from ..rules.channels import HOUSE_BRAND
from ..rules.ladder import ladder, mapped, part
from .channels import campaign_marks, network_source
from .returns import with_channel

SPEND_KEYS = (
    "geo_id refr_medium account_id campaign_id ad_group_id source medium campaign term match_type date"
).split()


def _rollup(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*SPEND_KEYS).agg(
        F.sum("impressions").cast("int").alias("impressions"),
        F.sum("cost").cast("double").alias("cost"),
        F.sum("clicks").cast("int").alias("clicks"),
        F.sum("reach").cast("int").alias("reach"),
    )


def ad_spend(
    adset_report: DataFrame,
    adgroup_report: DataFrame,
    adgroup_map: DataFrame,
    house_brand: str = HOUSE_BRAND
) -> DataFrame:
    """Cost of both ad platforms per campaign, term and day, in the shape the channel ladder reads."""
    account = F.lower("account_name")
    social = adset_report.select(
        # the house brand's name may hold '_', which LIKE reads as any character
        F.when(account.like(f"{house_brand}_de"), "de").otherwise("na").alias("geo_id"),
        F.lit("social").alias("refr_medium"),
        F.left(F.lower("account_id"), F.lit(255)).alias("account_id"),
        "campaign_id",
        F.col("adset_id").alias("ad_group_id"),
        F.lit("facebook").alias("source"),
        F.lit("sp").alias("medium"),
        F.left(F.lower("campaign_name"), F.lit(255)).alias("campaign"),
        F.lower("adset_name").alias("term"),
        F.lit("na").alias("match_type"),
        F.to_date("date").alias("date"),
        "impressions",
        F.col("spend").alias("cost"),
        "clicks",
        "reach",
    )
    known = adgroup_map.select(
        F.col("join_id").alias("_join"),
        F.col("medium").alias("_medium"),
        F.col("campaign").alias("_campaign"),
        F.col("term").alias("_term"),
    )
    report = adgroup_report.withColumn("_join", F.concat("account_id", "campaign_id", "ad_group_id"))
    report = lookup(report, known, ["_join"])
    search = report.select(
        ladder(
            [
                ("de", account.like("de%") | account.like("germ%")),
                ("nl", account.like("nl%") | account.like("neth%")),
            ],
            "na",
        ).alias("geo_id"),
        F.lit("search").alias("refr_medium"),
        F.left(F.lower("account_id"), F.lit(255)).alias("account_id"),
        "campaign_id",
        "ad_group_id",
        network_source(F.col("ad_network_type1")).alias("source"),
        F.left(F.coalesce("_medium", F.lit("cpc")), F.lit(255)).alias("medium"),
        F.left(F.lower(F.coalesce("_campaign", "campaign_name")), F.lit(255)).alias("campaign"),
        F.lower(F.coalesce("_term", "ad_group_name")).alias("term"),
        lower_not_null(part(F.col("_term"), 1)).alias("match_type"),
        F.to_date("date").alias("date"),
        "impressions",
        "cost",
        "clicks",
        F.lit(None).cast("int").alias("reach"),
    )
    # rolled up before the union, so each platform's rows shrink on their own
    rows = _rollup(social).unionByName(_rollup(search))
    return rows.withColumns(
        {
            "utm_id": F.md5(F.concat("source", "source", "medium", "campaign", "term", F.lit("f"))),
            "tagging_system": F.lit("utm-builder"),
            "is_lead_provider": F.lit(False),
            "is_home_landing": F.lit(False),
            **campaign_marks(F.col("campaign"), F.col("term")),
            "adgroup_id_from_utm": F.lit(None).cast("string"),
            "collector_tstamp": F.col("date").cast("timestamp"),
            "refr_host": F.col("source"),
            "content": F.lit(""),
            "join_id": F.lit(""),
        }
    )


def cost_keys(event_at: Column, date_id: Column, subtype: str) -> list[Column]:
    """The fixed part of a cost row in the marketing fact."""
    return [
        event_at.alias("event_at"),
        F.lit("cost").alias("fact_type"),
        F.lit(subtype).alias("fact_subtype"),
        F.lit("na").alias("session_id"),
        F.lit("na").alias("user_id"),
        F.lit(0).cast("long").alias("lead_id"),
        date_id.alias("date_id"),
        F.lit(0).alias("session_did"),
    ]


def spend_facts(spend: DataFrame, channels: DataFrame) -> DataFrame:
    """Rows of the marketing fact for advertising cost."""
    date = F.col("date")
    return with_channel(spend, channels).select(
        *cost_keys(date.cast("timestamp"), to_did(date), "mkt_spend"),
        "utm_id",
        "geo_id",
        F.col("_channel_vertical").alias("marketed_vertical_id"),
        F.lit(0).alias("vertical_type_id"),
        "cost",
        "impressions",
        "clicks",
        F.coalesce("_pbi", F.lit(1)).alias("pbi_utm_id"),
    )


# Sheet names and the channel names they stand for. The blank behind 'bing' belongs to
# the name and so to its key.
SHEET_CHANNELS = {
    "paid search": "paid search",
    "native": "native",
    "retargeting": "display remarketing",
}


def sheet_spend_prep(sheet: DataFrame) -> DataFrame:
    """Manually kept cost with channel, subchannel and channel key."""
    channel = F.left(mapped(F.col("marketing_channel"), SHEET_CHANNELS, "undefined"), F.lit(22))
    source = F.col("source")
    rows = sheet.withColumn("channel", channel)
    subchannel = ladder(
        [
            ("yahoo", source == "yahoo"),
            ("taboola", source == "taboola"),
            ("ligatus", source == "ligatus"),
            ("paid search bing ", (source == "bing") & (F.col("channel") == "paid search")),
            (
                "display retargeting sociomantic",
                (source == "smt") & (F.col("channel") == "display remarketing"),
            ),
        ],
        "undefined",
    )
    return rows.withColumn("subchannel", F.left(subchannel, F.lit(32))).select(
        to_did(F.col("date")).alias("date_id"),
        F.col("date").cast("timestamp").alias("event_at"),
        F.col("month_spend").alias("month_cost"),
        F.col("spend").alias("cost"),
        "channel",
        "subchannel",
        F.left("source", F.lit(128)).alias("source"),
        F.lit("de").alias("geo_id"),
        F.md5(F.concat("channel", "subchannel", "source")).alias("utm_id"),
    )


def sheet_channels(prepared: DataFrame) -> DataFrame:
    """Channel rows for the sheet's keys, with the few columns the sheet knows."""
    return prepared.select(
        F.left("utm_id", F.lit(32)).alias("utm_id"),
        F.left("channel", F.lit(15)).alias("channel"),
        F.left("channel", F.lit(22)).alias("mkt_channel"),
        F.left("subchannel", F.lit(32)).alias("mkt_subchannel"),
        F.left("source", F.lit(128)).alias("source"),
    ).distinct()


def manual_spend(
    prepared: DataFrame, channels: DataFrame
) -> DataFrame:
    """Rows of the marketing fact for manually kept cost."""
    return with_channel(prepared, channels).select(
        *cost_keys(F.col("event_at"), F.col("date_id"), "mkt_spend_manual"),
        "geo_id",
        F.lit(0).alias("vertical_type_id"),
        "cost",
        "utm_id",
        F.coalesce("_pbi", F.lit(1)).alias("pbi_utm_id"),
    )
