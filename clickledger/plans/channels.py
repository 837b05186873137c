"""Marketing parameters of events -> channel dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lower_not_null, to_int_code
from ..operators.dedupe import one_per_key
from ..operators.skew import lookup, spread_nulls
from ..rules import channels as rules
from ..rules.cities import city_style
from ..rules.ladder import mapped, part
from .sessions import DIRECT, LOADING, TIMEOUT, UNTRACKED

# Name of the ad network that is the search engine itself.
NETWORK_NAMES = {"search network": "google"}


def network_source(network: Column) -> Column:
    return mapped(F.lower(network), NETWORK_NAMES, F.lower(network))


def campaign_marks(campaign: Column, term: Column) -> dict[str, Column]:
    return {
        "position_2": part(campaign, 2),
        "city_style": city_style(campaign),
        "sn_camp": F.when(part(campaign, 2) == "sn", part(campaign, 1, "$")),
        "adgroup_id_from_utm": F.when(campaign.like("gaw_de_partner%"), part(term, 2)),
    }


def channel_prep(
    events: DataFrame,
    clicks: DataFrame,
    adgroup_map: DataFrame,
    start_at: Column | None = None,
    end_at: Column | None = None
) -> DataFrame:
    """Tidy marketing parameters and the channel key of every event with a countable referrer.

    An ad click known to the click report overrides what the URL says. Events without a click id or
    with an incomplete marketing string match nothing and are spread over the join's partitions.
    """
    rows = events.filter(
        rules.counts_as_referral(F.col("refr_urlhost"), F.col("page_referrer"))
    )
    if start_at is not None:
        rows = rows.filter(F.col("collector_tstamp") >= start_at)
    if end_at is not None:
        rows = rows.filter(F.col("collector_tstamp") <= end_at)
    rows = rows.select(
        "event_id",
        "event_fingerprint",
        "collector_tstamp",
        "page_urlpath",
        "refr_medium",
        "refr_urlhost",
        *[F.col(f"mkt_{c}").alias(f"_{c}") for c in ("source", "medium", "campaign", "term", "content")],
        F.to_date("collector_tstamp").alias("_date"),
        spread_nulls(F.col("mkt_clickid"), F.col("event_id")).alias("_click"),
        spread_nulls(
            F.concat("mkt_source", "mkt_medium", "mkt_campaign", "mkt_term"), F.col("event_id")
        ).alias("_string"),
    )
    click = clicks.select(
        F.col("gcl_id").alias("_click"),
        F.col("date").alias("_date"),
        F.col("campaign_id").alias("_g_campaign_id"),
        F.col("campaign_name").alias("_g_campaign"),
        F.col("ad_group_id").alias("_g_ad_group_id"),
        F.col("ad_group_name").alias("_g_ad_group"),
        F.col("ad_network_type1").alias("_g_network"),
        F.col("keyword_match_type").alias("_g_match"),
    )
    first_map = adgroup_map.filter(
        (F.col("marketing_string_rank") == 1) & F.col("marketing_string_id").isNotNull()
    ).select(
        F.col("marketing_string_id").alias("_string"),
        "join_id",
        "account_id",
        F.col("campaign_id").alias("_m_campaign_id"),
        F.col("ad_group_id").alias("_m_ad_group_id"),
        F.col("campaign").alias("_m_campaign"),
    )
    rows = rows.join(click, ["_click", "_date"], "left")
    rows = lookup(rows, first_map, ["_string"])

    clicked = F.col("_g_ad_group_id").isNotNull()
    tidy = rows.select(
        "event_id",
        "event_fingerprint",
        "collector_tstamp",
        (F.col("page_urlpath") == "/").alias("is_home_landing"),
        "refr_medium",
        F.when(F.col("_source").isNull() & (F.col("refr_medium") == "email"), "email")
        .when(clicked, network_source(F.col("_g_network")))
        .otherwise(F.lower("_source"))
        .alias("mkt_source"),
        F.when(clicked, "cpc").otherwise(lower_not_null(F.col("_medium"))).alias("medium"),
        lower_not_null(F.coalesce("_m_campaign", "_g_campaign", "_campaign")).alias("campaign"),
        lower_not_null(F.coalesce("_g_ad_group", "_term")).alias("term"),
        lower_not_null(F.coalesce(F.col("_g_match"), part(F.col("_term"), 1))).alias("match_type"),
        lower_not_null(F.col("_content")).alias("content"),
        "join_id",
        "account_id",
        F.coalesce("_m_campaign_id", "_g_campaign_id").alias("campaign_id"),
        F.coalesce("_m_ad_group_id", "_g_ad_group_id").alias("ad_group_id"),
        lower_not_null(rules.referrer_name(F.col("refr_urlhost"))).alias("refr_host"),
        F.lit(False).alias("is_lead_provider"),
    )
    campaign = F.col("campaign")
    return tidy.withColumns(
        {
            "utm_id": F.md5(
                F.concat(
                    F.coalesce("mkt_source", F.lit("")),
                    F.coalesce("refr_host", F.lit("")),
                    "medium",
                    "campaign",
                    "term",
                    "content",
                    F.when(F.col("is_home_landing"), "t").otherwise("f"),
                )
            ),
            "tagging_system": rules.tagging_system(campaign, F.col("is_lead_provider")),
            **campaign_marks(campaign, F.col("term")),
            "source": F.coalesce(F.nullif("mkt_source", F.lit("")), "refr_host"),
        }
    )


def latest_per_utm(prepared: DataFrame) -> DataFrame:
    """The newest row of each channel key."""
    ties = [F.col(c).desc() for c in ("event_id", "event_fingerprint") if c in prepared.columns]
    return one_per_key(prepared, ["utm_id"], [F.col("collector_tstamp").desc(), *ties])


def campaign_decode(prepared: DataFrame, house_brand: str = rules.HOUSE_BRAND) -> DataFrame:
    return prepared.withColumns(rules.campaign_parts(house_brand))


def channel_classify(prepared: DataFrame, house_brand: str = rules.HOUSE_BRAND) -> DataFrame:
    """The channel dimension from prepared rows: one row per channel key."""
    rows = campaign_decode(latest_per_utm(prepared), house_brand)
    rows = rows.withColumn("mkt_subchannel", F.left(rules.subchannel(), F.lit(32)))
    product = rules.product_of(F.col("product_raw"))

    def cut(column: Column | str, width: int) -> Column:
        return F.left(column, F.lit(width))

    return rows.select(
        "utm_id",
        "mkt_subchannel",
        cut(rules.channel_of(F.col("mkt_subchannel")), 22).alias("mkt_channel"),
        cut(rules.legacy_channel(), 16).alias("channel"),
        F.lit("web").alias("mkt_medium"),
        product.alias("product"),
        to_int_code(product, 4).alias("vertical_type_id"),
        cut("medium", 32).alias("medium"),
        cut(F.coalesce("source", F.lit("other")), 128).alias("source"),
        cut("source", 128).alias("detailed_source"),
        cut("refr_host", 128).alias("referrer"),
        cut("campaign", 128).alias("campaign"),
        cut("term", 128).alias("term"),
        cut("content", 500).alias("content"),
        "refr_medium",
        "is_lead_provider",
        (~F.col("is_lead_provider")).cast("int").alias("bin_internal"),
        "city_style",
        "city",
        "extended_city",
        "prefix",
        "push",
        "audience",
        "sub_audience",
        "campaign_date",
        "crm_data",
        "join_id",
        "account_id",
        cut("campaign_id", 32).alias("campaign_id"),
        cut("ad_group_id", 32).alias("ad_group_id"),
        "match_type",
        F.col("collector_tstamp").alias("updated_at"),
        F.lit(None).cast("bigint").alias("pbi_utm_id"),
    )


SEED_TEXT = (
    "channel mkt_channel mkt_subchannel mkt_medium product medium source detailed_source referrer "
    "campaign term content refr_medium city_style city extended_city prefix push audience sub_audience "
    "campaign_date crm_data join_id account_id campaign_id ad_group_id match_type"
).split()
_NAMED = "channel mkt_channel mkt_subchannel mkt_medium medium source detailed_source".split()
_URL = "referrer campaign term content".split()


def channel_seed_rows(spark: SparkSession) -> DataFrame:
    """The four dummy channels: direct, untracked, timeout, loading."""
    direct = dict.fromkeys(SEED_TEXT, "na")
    direct |= dict.fromkeys(_NAMED, "direct") | dict.fromkeys([*_URL, "refr_medium"], "")
    direct |= {"mkt_channel": "brand", "mkt_medium": "web"}
    rows = [{"utm_id": DIRECT, **direct, "bin_internal": 1, "pbi_utm_id": None}]
    for key, name in ((UNTRACKED, "untracked"), (TIMEOUT, "timeout")):
        text = dict.fromkeys(SEED_TEXT, "na") | dict.fromkeys(_NAMED, name) | {"refr_medium": ""}
        rows.append({"utm_id": key, **text, "bin_internal": 1, "pbi_utm_id": None})
    loading = dict.fromkeys(SEED_TEXT, "loading") | {"match_type": "na"}
    rows.append({"utm_id": LOADING, **loading, "bin_internal": 0, "pbi_utm_id": 1})
    for row in rows:
        row |= {"vertical_type_id": 0, "is_lead_provider": False, "updated_at": datetime(1970, 1, 1)}
    schema = T.StructType(
        [T.StructField("utm_id", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in SEED_TEXT]
        + [
            T.StructField("vertical_type_id", T.LongType()),
            T.StructField("is_lead_provider", T.BooleanType()),
            T.StructField("bin_internal", T.IntegerType()),
            T.StructField("updated_at", T.TimestampType()),
            T.StructField("pbi_utm_id", T.LongType()),
        ]
    )
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def channel_dimension(prepared: DataFrame, house_brand: str = rules.HOUSE_BRAND) -> DataFrame:
    """A rebuilt channel dimension with its dummy rows."""
    return channel_classify(prepared, house_brand).unionByName(
        channel_seed_rows(prepared.sparkSession)
    )
