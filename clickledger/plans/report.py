"""The cumulative marketing report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import lookup

VALUES = ["sessions", "leads", "valid_leads", "cost"]


def cumulative_marketing(
    facts: DataFrame, channels: DataFrame, dates: DataFrame, as_of: date
) -> DataFrame:
    """Daily values by medium and channel, running sums and previous day within each month.

    `dates`: day number, date and month of each calendar day. The months asked for pick the fact's partitions when the job
    runs. Facts shrink to one row per day and channel before any window, so a window never holds more than
    a month of days.
    """
    today = F.lit(as_of)
    asked = dates.filter(F.col("month") >= F.add_months(today, -2)).select(
        "date_id",
        "date",
        "month",
        ((F.year(today) - F.year("date")) * 12 + F.month(today) - F.month("date")).alias("months_ago"),
    )
    dated = facts.filter(F.col("event_at") > F.date_sub(today, 65)).withColumnRenamed("fact_month", "month")
    recent = dated.join(asked, ["month", "date_id"])
    names = channels.select("utm_id", "mkt_medium", "mkt_channel")
    daily = (
        lookup(recent, names, ["utm_id"])
        .groupBy("date", "month", "months_ago", "mkt_medium", "mkt_channel")
        .agg(
            F.sum("sessions").alias("sessions"),
            F.countDistinct("lead_id").alias("leads"),
            F.sum("lc_valid_leads").alias("valid_leads"),
            F.sum("cost").alias("cost"),
        )
    )
    by_month = Window.partitionBy("month", "mkt_medium", "mkt_channel").orderBy("date")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "date",
        "month",
        F.dayofmonth("date").alias("day_of_month"),
        "months_ago",
        "mkt_medium",
        "mkt_channel",
        *VALUES,
        *[F.sum(v).over(so_far).alias(f"cumulative_{v}") for v in VALUES],
        *[F.lag(v).over(by_month).alias(f"lag_{v}") for v in VALUES],
        (F.dayofmonth("date") <= F.dayofmonth(today)).cast("int").alias("bin_lag_reference"),
    )
