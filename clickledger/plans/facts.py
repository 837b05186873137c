"""The marketing fact: one catalog table, partitioned by kind and month, that several jobs feed.

Each job replaces its own rows only: returns by lead, cost of ad platforms from its first day on, cost sheets and visits as a
whole. Months that a job does not touch are neither read nor written. A job that is repeated after a failure finds the
same rows to replace. Days would be partitions of a few rows each for leads and sheets.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import from_did, to_did
from ..operators.skew import lookup
from ..rules.measures import MEASURES
from ..session import written
from ..sources.warehouse import drop_partitions, ensure_table, overwrite_partitions

PARTITIONS = ["fact_subtype", "fact_month"]
RETURNS, SPEND, SHEET, VISITS = "lead", "mkt_spend", "mkt_spend_manual", "session"
COLUMNS = {
    "event_at": "timestamp",
    **dict.fromkeys(["fact_type", "session_id", "user_id"], "string"),
    "lead_id": "bigint",
    "session_did": "int",
    **dict.fromkeys(["utm_id", "geo_id"], "string"),
    "marketed_vertical_id": "bigint",
    "vertical_type_id": "int",
    "sessions": "bigint",
    **{f"{prefix}{m}": "double" for prefix in ("", "lc_") for m in MEASURES},
    "cost": "double",
    **dict.fromkeys(["impressions", "clicks", "pbi_utm_id"], "bigint"),
    "date_id": "int",
    "fact_subtype": "string",
    "fact_month": "date",
}


def create(spark: SparkSession, table: str) -> None:
    ensure_table(spark, table, ", ".join(f"{c} {kind}" for c, kind in COLUMNS.items()), PARTITIONS)


def in_shape(rows: DataFrame) -> DataFrame:
    """Rows with all columns of the fact; those that a job does not know are NULL."""
    rows = rows.withColumn("fact_month", F.trunc(from_did(F.col("date_id")), "month"))
    known = set(rows.columns)
    return rows.select(
        *[(F.col(c) if c in known else F.lit(None)).cast(kind).alias(c) for c, kind in COLUMNS.items()]
    )


def visit_facts(sessions: DataFrame) -> DataFrame:
    """Rows of the marketing fact for visits, one for each session."""
    return sessions.select(
        F.col("start_collector_tstamp").alias("event_at"),
        F.lit("session").alias("fact_type"),
        F.lit(VISITS).alias("fact_subtype"),
        "session_id",
        F.col("domain_userid").alias("user_id"),
        F.col("start_did").alias("date_id"),
        F.col("start_did").alias("session_did"),
        "utm_id",
        "geo_id",
        F.lit(1).alias("sessions"),
    )


def _months(rows: DataFrame) -> list[date | None]:
    """Months that occur; rows without a day have NULL."""
    return [r["fact_month"] for r in rows.select("fact_month").distinct().collect()]


def _in(months: list[date | None]) -> Column:
    known = [m for m in months if m is not None]
    inside = F.coalesce(F.col("fact_month").isin(known), F.lit(False)) if known else F.lit(False)
    return inside | F.col("fact_month").isNull() if None in months else inside


def _replace(kept: DataFrame, stage: DataFrame, table: str, subtype: str, months: list[date | None]) -> None:
    """The months of a kind hold what is kept of them and the stage, nothing else."""
    spark = stage.sparkSession
    # the stage is written already; only rows that come from the table itself have to leave it first
    kept = written(kept.select(*stage.columns), "fact-months", "zstd")
    filled = {*_months(kept), *_months(stage)}
    # written as the rows lie: a month gets a file from each part of the stage that has rows of it
    overwrite_partitions(kept.unionByName(stage), table, gather=False)
    drop_partitions(spark, table, [{"fact_subtype": subtype, "fact_month": m} for m in months if m not in filled])
    spark.catalog.refreshTable(table)


def load_returns(rows: DataFrame, table: str) -> None:
    """Replace the rows of the staged leads, wherever their days were, by the stage.

    Staged rows without a lead are added to their months; loaded again they come twice, as the rows of no lead are replaced.
    """
    stage = written(in_shape(rows).filter(F.col("fact_subtype") == RETURNS), "returns-stage", "zstd")
    leads = stage.select("lead_id").dropna().distinct()
    loaded = rows.sparkSession.table(table).filter(F.col("fact_subtype") == RETURNS)
    before = _months(loaded.select("lead_id", "fact_month").join(leads, "lead_id", "left_semi"))
    months = list({*before, *_months(stage)})
    loaded = loaded.filter(_in(months))
    # which leads stay is found by their ids alone; the rows are sent to meet them only where these are many. NULL stays
    staying = written(lookup(loaded.select("lead_id").distinct(), leads, ["lead_id"], "left_anti"), "kept-leads")
    staying = staying.withColumnRenamed("lead_id", "_staying")
    kept = loaded.join(staying, F.col("lead_id").eqNullSafe(F.col("_staying")), "left_semi")
    _replace(kept, stage, table, RETURNS, months)


def load_costs(rows: DataFrame, table: str, subtype: str, tail_only: bool = False) -> None:
    """Replace all rows of a kind by the stage, or with `tail_only` those from its first day on.

    An empty stage then changes nothing; else it clears the kind.
    """
    stage = written(in_shape(rows).filter(F.col("fact_subtype") == subtype), "cost-stage", "zstd")
    loaded = rows.sparkSession.table(table).filter(F.col("fact_subtype") == subtype)
    kept = loaded.filter("false")
    if tail_only:
        first = stage.agg(F.min("date_id").alias("day"), F.min("fact_month").alias("month")).first()
        if first["day"] is None:
            return
        loaded = loaded.filter(F.col("fact_month") >= first["month"])
        kept = loaded.filter((F.col("fact_month") == first["month"]) & (F.col("date_id") < first["day"]))
    _replace(kept, stage, table, subtype, _months(loaded))


def date_dimension(spark: SparkSession, first: str = "1990-01-01", last: str = "2099-12-31") -> DataFrame:
    """One row for each calendar day, by day number."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")
    )
    return days.select(to_did(F.col("date")).alias("date_id"), "date", F.trunc("date", "month").alias("month"))
