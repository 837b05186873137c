"""Attributed returns and the marketing fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup
from ..rules.measures import MEASURES
from .sessions import UNTRACKED

RETURN_KEYS = [
    "lead_id",
    "lead_created_at",
    "date_id",
    "utm_id",
    "marketed_vertical_id",
    "session_id",
    "geo_id",
]


def weighted_sums(weights: dict[str, Column], measures: list[str]) -> list[Column]:
    """SUM(weight * measure) for each prefix and measure; a missing weight counts fully."""
    return [
        F.sum(F.coalesce(weight, F.lit(1.0)) * F.col(m)).alias(f"{prefix}{m}")
        for prefix, weight in weights.items()
        for m in measures
    ]


def attributed_return(leads: DataFrame, paths: DataFrame, sessions: DataFrame) -> DataFrame:
    """Lead measures spread over the sessions of their path by the custom and the last-click model.

    A lead without a path keeps its full value on its own channel key. The lead price is not
    weighted: a path of n sessions repeats it n times.
    """
    touches = (
        paths.select("conversion_path_id", "session_id", "custom", "last")
        .join(
            sessions.select(
                "session_id",
                "start_did",
                F.col("utm_id").alias("_utm"),
                F.col("geo_id").alias("_geo"),
                F.lit(True).alias("_known"),
            ),
            "session_id",
            "left",
        )
        .withColumn("session_id", F.when(F.col("_known"), F.col("session_id")))
        .drop("_known")
    )
    # an inner join, of which AQE can split either side where one path is very long; a left join from
    # the leads would have to keep the long side whole
    with_path = touches.join(leads, "conversion_path_id")
    without = leads.join(
        touches.select("conversion_path_id").distinct(), "conversion_path_id", "left_anti"
    )
    rows = with_path.unionByName(without, allowMissingColumns=True)
    return (
        rows.select(
            "lead_id",
            "lead_created_at",
            F.coalesce("start_did", "lead_created_did").alias("date_id"),
            F.coalesce("_utm", "utm_id", F.lit(UNTRACKED)).alias("utm_id"),
            F.col("primary_vertical_type_id").alias("marketed_vertical_id"),
            F.coalesce("session_id", F.lit("na")).alias("session_id"),
            F.coalesce("_geo", "geo_id").alias("geo_id"),
            "lead_price",
            "custom",
            "last",
            *MEASURES,
        )
        # a group is mostly one row, which is narrower than its weighted sums: rows are sent, not partial sums
        .repartition(*RETURN_KEYS)
        .groupBy(*RETURN_KEYS)
        .agg(
            F.sum("lead_price").alias("cost"),
            *weighted_sums({"": F.col("custom"), "lc_": F.col("last")}, MEASURES),
        )
    )


FACT_KEYS = (
    "event_at fact_type fact_subtype session_id user_id lead_id date_id session_did utm_id geo_id "
    "marketed_vertical_id vertical_type_id"
).split()


def with_channel(rows: DataFrame, channels: DataFrame) -> DataFrame:
    keys = channels.select(
        "utm_id",
        F.col("vertical_type_id").alias("_channel_vertical"),
        F.col("pbi_utm_id").alias("_pbi"),
    )
    return lookup(rows, keys, ["utm_id"])


def return_facts(
    returns: DataFrame, channels: DataFrame
) -> DataFrame:
    """Rows of the marketing fact for attributed returns."""
    values = [c for c in returns.columns if c not in RETURN_KEYS]
    return with_channel(returns, channels).select(
        F.col("lead_created_at").alias("event_at"),
        F.lit("conversion").alias("fact_type"),
        F.lit("lead").alias("fact_subtype"),
        "session_id",
        F.col("lead_id").cast("string").alias("user_id"),
        "lead_id",
        "date_id",
        F.col("date_id").alias("session_did"),
        "utm_id",
        F.coalesce("geo_id", F.lit("na")).alias("geo_id"),
        F.coalesce("_channel_vertical", "marketed_vertical_id", F.lit(0)).alias(
            "marketed_vertical_id"
        ),
        F.lit(0).alias("vertical_type_id"),
        *values,
        F.coalesce("_pbi", F.lit(1)).alias("pbi_utm_id"),
    )
