"""Event streams: bounded runs, late data, copies, timeout sessions and published snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunked import carried_last
from ..operators.skew import DEFAULT_RULE, HotKeyRule, hot_keys, per_heat, with_slices
from ..plans.incremental import Store, land, map_sessions
from ..session import written
from ..sources.warehouse import snapshot, swap_in

TIMEOUT_SECONDS = 1800
LATENESS = "1 day"


def sessionize_stream(
    events: DataFrame, store: Store, checkpoint: str, rule: HotKeyRule = DEFAULT_RULE
) -> StreamingQuery:
    """Keep stored events and their session map up to date, one bounded run over all that is new.

    Each batch is a delivery of `plans.incremental`: it recomputes just the days it touches, late events included, and
    reads the stored events of those days only. A batch that is repeated after a failure overwrites itself.
    `derived_ranking` counts within the recomputed days, as in any incremental run.
    """

    def load(batch: DataFrame, number: int) -> None:
        land(batch, store, number)
        map_sessions(batch.sparkSession, store, rule)

    return (
        events.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def without_copies(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """A stream without repeated events. It keeps the first copy; batch runs keep the newest."""
    return events.withWatermark("collector_tstamp", lateness).dropDuplicatesWithinWatermark(
        ["event_id", "event_fingerprint"]
    )


def timeout_windows(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Tracker sessions of a stream: a user's events with gaps of less than half an hour."""
    return (
        events.withWatermark("collector_tstamp", lateness)
        .groupBy("domain_userid", F.session_window("collector_tstamp", f"{TIMEOUT_SECONDS} seconds"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            "domain_userid",
            F.col("session_window.start").alias("start_at"),
            (F.col("session_window.end") - F.expr(f"INTERVAL {TIMEOUT_SECONDS} SECONDS")).alias("end_at"),
            "events",
        )
    )


def timeout_sessions(events: DataFrame, rule: HotKeyRule = DEFAULT_RULE) -> DataFrame:
    """The same tracker sessions for a table."""
    hits = events.filter(F.col("domain_userid").isNotNull()).select(
        "domain_userid", "collector_tstamp", "event_id"
    )
    user, order = ["domain_userid"], ["collector_tstamp", "event_id"]

    def cut(rows: DataFrame, chunk: list[str]) -> DataFrame:
        at = F.col("collector_tstamp")
        rows = carried_last(rows, user, order, chunk, at, "_before", False)
        gap = F.unix_micros(at) - F.unix_micros("_before")
        new = F.col("_before").isNull() | (gap > TIMEOUT_SECONDS * 1_000_000)
        rows = rows.withColumn("_start", F.when(new, at))
        return carried_last(rows, user, order, chunk, F.col("_start"), "start_at", True)

    hot = hot_keys(hits, user, "collector_tstamp", rule)
    rows = per_heat(with_slices(hits, user, "collector_tstamp", hot), hot, cut)
    return rows.groupBy("domain_userid", "start_at").agg(
        F.max("collector_tstamp").alias("end_at"), F.count(F.lit(1)).alias("events")
    )


def publish_stream(figures: DataFrame, table: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Keep a published table up to date with the stamped figures of a stream.

    `figures` is a stream grouped by `keys` with its aggregates: their running state is kept by the engine, so a run reads only what is
    new and gets the groups that changed, with their new figures. These replace the table's rows of the same keys. A batch that is
    repeated brings the same figures and so the same table.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        changed = written(snapshot(batch), "changed-figures")
        rows = changed
        if spark.catalog.tableExists(table):
            new = changed.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
            rows = spark.table(table).join(new, same, "left_anti").unionByName(changed)
        swap_in(rows, table)

    return (
        figures.writeStream.outputMode("update")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
