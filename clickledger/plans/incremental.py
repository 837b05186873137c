"""Sessions and channels kept in stored tables, delivery by delivery.

Each delivery of events is landed once, partitioned by Berlin day and delivery. A run takes the deliveries
beyond the high-water mark that the load log has for a job, recomputes the days they touch and replaces just those
day partitions. The mark is committed after the data, so a run that dies is simply repeated: it finds the same
deliveries and overwrites what it had written.

Sessions never cross a Berlin day. The newest copy of an event decides its day, so a copy on another day
touches that day as well. Copies are found in an index of keys (slot, event, day), of which a run reads only the
slots of what arrived; the stored events are never searched or shuffled as a whole. Events whose copies lie on several
days are kept in a small table, which tells a recomputed day which of its rows are outdated.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import berlin_local
from ..operators.skew import DEFAULT_RULE, HotKeyRule
from ..session import written
from ..sources.warehouse import drop_partitions, ensure_table, overwrite_partitions
from .channels import channel_prep, latest_per_utm
from .sessions import session_bounds, session_facts, sessionize

LAND, MAP, SESSIONS, CHANNELS = "events_start", "event_session_map", "sessions", "channels"
KEY = ["event_id", "event_fingerprint"]
LOG = "job_title string, delivery bigint, logged_at timestamp, days array<date>"


@dataclass(frozen=True)
class Store:
    """Tables of one warehouse by a common prefix. `slots`: parts of the key index and of the channels."""

    name: str
    slots: int = 64

    def table(self, part: str) -> str:
        return f"{self.name}_{part}"


@dataclass(frozen=True)
class Inputs:
    """Tables that runs look things up in."""

    clicks: DataFrame
    adgroup_map: DataFrame
    tv_peaks: DataFrame
    iso_codes: DataFrame
    users: DataFrame
    utm_ids: DataFrame


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("berlin_day", F.to_date(berlin_local(F.col("collector_tstamp"))))


def on_days(days: list[date]) -> Column:
    return F.col("berlin_day").isin(days) if days else F.lit(False)


# --- the load log -------------------------------------------------------------------------------


def commit(spark: SparkSession, store: Store, job: str, delivery: int, days: list[date], at: datetime) -> None:
    """Move the high-water mark of a job; call it when the data is in place."""
    table = store.table("load_log")
    ensure_table(spark, table, LOG, [])
    rows = spark.createDataFrame([(job, delivery, at, days)], LOG)
    rows.coalesce(1).write.insertInto(table)
    spark.catalog.refreshTable(table)


def marked(spark: SparkSession, store: Store, job: str) -> int:
    """The last delivery that a job has done; -1 before the first."""
    table = store.table("load_log")
    if not spark.catalog.tableExists(table):
        return -1
    spark.catalog.refreshTable(table)
    top = spark.table(table).filter(F.col("job_title") == job).agg(F.max("delivery").alias("d")).first()["d"]
    return -1 if top is None else top


def pending(spark: SparkSession, store: Store, job: str, source: str) -> tuple[list[int], list[date]]:
    """Deliveries that the source job has done and this one has not, and the days they touch."""
    log = store.table("load_log")
    if not spark.catalog.tableExists(log):
        return [], []
    mark = marked(spark, store, job)
    new = spark.table(log).filter((F.col("job_title") == source) & (F.col("delivery") > mark))
    # one row per run, with its calendar days
    found = new.select("delivery", "days").collect()
    return sorted({r["delivery"] for r in found}), list({d for r in found for d in r["days"]})


# --- jobs ---------------------------------------------------------------------------------------


def land(rows: DataFrame, store: Store, delivery: int, at: datetime | None = None) -> None:
    """Store a delivery of events under its number. Landed again, it replaces itself.

    Events without a time lie in no run's window and are left out.
    """
    spark = rows.sparkSession
    table = store.table("events")
    arrived = with_day(rows.filter(F.col("collector_tstamp").isNotNull())).withColumn("delivery", F.lit(delivery).cast("long"))
    ensure_table(spark, table, arrived.schema, ["berlin_day", "delivery"])
    overwrite_partitions(arrived, table, gather=False)
    spark.catalog.refreshTable(table)
    landed = spark.table(table).filter(F.col("delivery") == delivery)
    # a partition column: no more than one row per calendar day
    days = [r["berlin_day"] for r in landed.select("berlin_day").distinct().collect()]
    commit(spark, store, LAND, delivery, days, at or datetime.now())


def _slot(store: Store) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(store.slots)).cast("int")


def touched_days(spark: SparkSession, store: Store, deliveries: list[int], arrived_days: list[date]) -> list[date]:
    """Days that deliveries change; adds their keys to the index and notes events with copies on several days."""
    index, moved = store.table("keys"), store.table("moved")
    last = deliveries[-1]
    arrived = written(
        spark.table(store.table("events"))
        .filter(on_days(arrived_days) & F.col("delivery").isin(deliveries))
        .filter(F.col("event_id").isNotNull() & F.col("event_fingerprint").isNotNull())
        .groupBy(*KEY)
        .agg(F.collect_set("berlin_day").alias("days"))
        .select(*KEY, "days", _slot(store).alias("slot"), F.lit(last).cast("long").alias("delivery")),
        "arrived-keys",
        "zstd",
    )
    ensure_table(spark, index, arrived.schema, ["slot", "delivery"])
    schema = "event_id string, event_fingerprint string, last_day date, delivery long"
    ensure_table(spark, moved, schema, ["delivery"])
    spark.catalog.refreshTable(index)
    # at most `slots` values
    slots = [r["slot"] for r in arrived.select("slot").distinct().collect()]
    older = spark.table(index).filter(F.col("slot").isin(slots) & (F.col("delivery") < last))
    before = older.select(*KEY, F.col("days").alias("older"))
    copies = written(
        arrived.join(before, KEY, "left")
        .groupBy(*KEY, "days")
        .agg(F.flatten(F.collect_list("older")).alias("older"))
        .withColumn("all", F.array_distinct(F.concat("days", "older")))
        .filter(F.size("all") > 1),
        "copied-keys",
    )
    overwrite_partitions(arrived, index, gather=False)
    overwrite_partitions(
        copies.select(*KEY, F.array_max("all").alias("last_day"), F.lit(last).cast("long").alias("delivery")), moved
    )
    spark.catalog.refreshTable(moved)
    others = [r["day"] for r in copies.select(F.explode("all").alias("day")).distinct().collect()]
    return list({*arrived_days, *others})


def current_events(spark: SparkSession, store: Store, days: list[date]) -> DataFrame:
    """Stored events of some days without those that have a newer copy on a later day."""
    rows = spark.table(store.table("events")).filter(on_days(days)).drop("delivery")
    # written, so that its size is known: where few events have moved, the stored ones are not shuffled to find them
    last = written(spark.table(store.table("moved")).groupBy(*KEY).agg(F.max("last_day").alias("last_day")), "moved")
    rows = rows.join(last, KEY, "left")
    return rows.filter(F.col("last_day").isNull() | (F.col("berlin_day") == F.col("last_day"))).drop("last_day")


def _replace_days(rows: DataFrame, table: str, days: list[date]) -> None:
    """Replace days by the rows, which are written once and as they lie: a day gets a file from each task that has rows of it."""
    spark = rows.sparkSession
    ensure_table(spark, table, rows.schema, ["berlin_day"])
    seen = Observation()
    # no more than one value per calendar day
    overwrite_partitions(rows.observe(seen, F.collect_set("berlin_day").alias("days")), table, gather=False)
    filled = set(seen.get["days"])
    drop_partitions(spark, table, [{"berlin_day": d} for d in days if d not in filled])
    spark.catalog.refreshTable(table)


def map_sessions(spark: SparkSession, store: Store, rule: HotKeyRule = DEFAULT_RULE, at: datetime | None = None) -> None:
    """Recompute the event -> session map of the days that new deliveries touch."""
    deliveries, arrived_days = pending(spark, store, MAP, LAND)
    if not deliveries:
        return
    spark.catalog.refreshTable(store.table("events"))
    if not arrived_days:
        return commit(spark, store, MAP, deliveries[-1], [], at or datetime.now())
    days = touched_days(spark, store, deliveries, arrived_days)
    mapped = with_day(sessionize(current_events(spark, store, days), rule=rule))
    _replace_days(mapped, store.table("session_map"), days)
    commit(spark, store, MAP, deliveries[-1], days, at or datetime.now())


def load_sessions(spark: SparkSession, store: Store, inputs: Inputs, at: datetime | None = None) -> None:
    """Recompute the session facts of the days whose session map has changed."""
    deliveries, days = pending(spark, store, SESSIONS, MAP)
    if not deliveries:
        return
    if not days:
        return commit(spark, store, SESSIONS, deliveries[-1], [], at or datetime.now())
    mapped = spark.table(store.table("session_map")).filter(on_days(days)).drop("berlin_day")
    events = spark.table(store.table("events")).filter(on_days(days)).drop("berlin_day", "delivery")
    bounds = session_bounds(mapped, events)
    prepared = channel_prep(events, inputs.clicks, inputs.adgroup_map)
    facts = session_facts(
        bounds, prepared, inputs.tv_peaks, inputs.iso_codes, inputs.users, inputs.utm_ids, events=events
    )
    day = F.to_date(berlin_local(F.col("start_collector_tstamp")))
    _replace_days(facts.withColumn("berlin_day", day), store.table("sessions"), days)
    commit(spark, store, SESSIONS, deliveries[-1], days, at or datetime.now())


def load_channels(spark: SparkSession, store: Store, inputs: Inputs, at: datetime | None = None) -> None:
    """Merge the marketing parameters that arrived into the newest row of each channel key."""
    deliveries, days = pending(spark, store, CHANNELS, LAND)
    if not deliveries:
        return
    if not days:
        return commit(spark, store, CHANNELS, deliveries[-1], [], at or datetime.now())
    table = store.table("channel_prep")
    events = (
        spark.table(store.table("events"))
        .filter(on_days(days) & F.col("delivery").isin(deliveries))
        .drop("berlin_day", "delivery")
    )
    slot = F.pmod(F.xxhash64("utm_id"), F.lit(store.slots)).cast("int")
    stage = written(
        latest_per_utm(channel_prep(events, inputs.clicks, inputs.adgroup_map)).withColumn("slot", slot), "channels", "zstd"
    )
    ensure_table(spark, table, stage.schema, ["slot"])
    slots = [r["slot"] for r in stage.select("slot").distinct().collect()]
    known = spark.table(table).filter(F.col("slot").isin(slots))
    # the known rows are read from the partitions that are replaced, which stay in place until all rows are written
    overwrite_partitions(latest_per_utm(known.unionByName(stage)), table, gather=False)
    spark.catalog.refreshTable(table)
    commit(spark, store, CHANNELS, deliveries[-1], days, at or datetime.now())


def run(spark: SparkSession, store: Store, inputs: Inputs) -> None:
    """All jobs, each from its own mark on; with nothing new they do nothing."""
    map_sessions(spark, store)
    load_sessions(spark, store, inputs)
    load_channels(spark, store, inputs)
