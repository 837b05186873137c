"""Clicks joined to events -> which marketing parameters an ad group uses."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import berlin_local, decode_url
from ..operators.loads import unseen
from ..rules.ladder import part

FIRST_DATE = date(2017, 6, 1)


def click_match(clicks: DataFrame, events: DataFrame) -> DataFrame:
    """Clicks with their event: same click id, and the click's date is the event's in UTC or Berlin.

    The click id is the join key; the two dates are only compared for rows that share it.
    """
    hits = events.filter(F.col("mkt_clickid").isNotNull()).select(
        F.col("mkt_clickid").alias("gcl_id"),
        "collector_tstamp",
        "event_id",
        *[f"mkt_{c}" for c in ("source", "medium", "term", "content")],
    )
    ts = F.col("collector_tstamp")
    same_day = (F.col("date") == F.to_date(ts)) | (F.col("date") == F.to_date(berlin_local(ts)))
    return clicks.join(hits, "gcl_id").filter(same_day)


def adgroup_utm_map(
    clicks: DataFrame, events: DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """Per ad group the last known marketing parameters, ranked within equal marketing strings."""
    new = clicks.withColumn("join_id", F.concat("account_id", "campaign_id", "ad_group_id")).filter(
        F.col("join_id").isNotNull() & (F.col("date") > F.lit(FIRST_DATE))
    )
    if known is not None:
        new = unseen(new, known, "join_id")
    matched = click_match(new, events)
    values = {
        "source": F.trim(F.lower("mkt_source")),
        "medium": F.trim(F.lower("mkt_medium")),
        "campaign": F.trim(F.lower("campaign_name")),
        "term": F.trim(F.lower("mkt_term")),
        "content": F.trim(F.lower("mkt_content")),
    }
    # the event only breaks ties between clicks of one day
    at = F.struct("date", "collector_tstamp", "event_id")

    def last_known(value):
        return F.max(F.when(value.isNotNull(), F.struct(at.alias("at"), value.alias("value"))))

    ids = ["join_id", "account_id", "campaign_id", "ad_group_id"]
    per_id = matched.groupBy(*ids).agg(
        *[last_known(v).alias(name) for name, v in values.items()],
        F.max("date").alias("click_date"),
    )
    group = Window.partitionBy("ad_group_id")
    spread = per_id.select(
        *ids,
        *[F.max(name).over(group).getField("value").alias(name) for name in values],
        F.max("click_date").over(group).alias("click_date"),
    ).withColumn("marketing_string_id", F.concat("source", "medium", "campaign", "term"))
    rank = Window.partitionBy("marketing_string_id").orderBy(
        F.col("click_date").desc(), F.col("join_id").asc()
    )
    return spread.select(
        "marketing_string_id",
        F.row_number().over(rank).alias("marketing_string_rank"),
        *ids,
        *values,
        "click_date",
        decode_url(part(F.col("content"), 4)).alias("keyword"),
    )
