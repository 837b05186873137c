from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.incremental import Store
from ..session import shared_dir
from ..sources.shapes import SHAPES
from ..streaming import events as streams
from ..streaming.sessions import write_exact_sessions
from .registry import Tables, query


def event_stream(spark, sf_dir) -> DataFrame:
    """The raw events as a stream of files, in the shape of web events."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    hits = spark.sql(SHAPES["web_hits"], events=raw)
    return spark.sql(SHAPES["web_events"], web_hits=hits)


@query("sessionize_stream", "streamed_sessions")
def _(spark, sf_dir):
    name = uuid.uuid4().hex
    store = Store(f"stream_{name}")
    progress = f"{shared_dir(spark)}/stream-{name}"
    streams.sessionize_stream(event_stream(spark, sf_dir), store, progress).awaitTermination()
    # another session wrote it
    spark.catalog.refreshTable(store.table("session_map"))
    return spark.table(store.table("session_map")).select(
        "session_id", "event_id", "collector_tstamp", "session_event_index", "is_external"
    )


@query("timeout_sessions", "tracker_sessions")
def _(spark, sf_dir):
    return streams.timeout_sessions(Tables(spark, sf_dir).web_events)


@query("timeout_windows", "tracker_sessions")
def _(spark, sf_dir):
    events = Tables(spark, sf_dir).web_events.filter(F.col("domain_userid").isNotNull())
    return streams.timeout_windows(events)


def _deliver(spark, rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").parquet(folder)


def _stream_of(spark, rows: DataFrame, folder: str) -> DataFrame:
    return spark.readStream.schema(rows.schema).parquet(folder)


def _parts(events: DataFrame, n: int) -> list[DataFrame]:
    """Deliveries in order of time, each with copies of its own."""
    at = F.unix_micros("collector_tstamp")
    ends = events.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    step = (ends["high"] - ends["low"]) // n + 1
    place = F.floor((at - ends["low"]) / step)
    return [events.filter(place == k) for k in range(n)]


def _to_table(spark, stream: DataFrame, folder: str) -> None:
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
        .awaitTermination()
    )


@query("stream_copies", "ids_once")
def _(spark, sf_dir):
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = Tables(spark, sf_dir).web_events.select("event_id", "event_fingerprint", "collector_tstamp", "event")
    for part in _parts(events, 2):
        _deliver(spark, part, f"{folder}/in")
        _to_table(spark, streams.without_copies(_stream_of(spark, part, f"{folder}/in")), folder)
    return spark.read.parquet(f"{folder}/out").select("event_id", "event_fingerprint", "event")


@query("stream_timeouts", "tracker_sessions")
def _(spark, sf_dir):
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = (
        Tables(spark, sf_dir).web_events.filter(F.col("domain_userid").isNotNull())
        .select("domain_userid", "collector_tstamp")
    )
    last = events.agg(F.max("collector_tstamp").alias("at"))
    # later events of nobody move the watermark past all windows
    ends = [last.select(F.lit("").alias("domain_userid"), (F.col("at") + F.expr(f"INTERVAL {d} DAYS")).alias("collector_tstamp")) for d in (30, 60)]
    for part in [*_parts(events, 2), *ends]:
        _deliver(spark, part.select("domain_userid", "collector_tstamp"), f"{folder}/in")
        _to_table(spark, streams.timeout_windows(_stream_of(spark, events, f"{folder}/in")), folder)
    return spark.read.parquet(f"{folder}/out").filter("domain_userid <> ''")


@query("stream_snapshot", "events_by_kind")
def _(spark, sf_dir):
    """Three deliveries, of which each run reads its own only."""
    name = uuid.uuid4().hex
    folder, table = f"{shared_dir(spark)}/stream-{name}", f"snapshot_{name}"
    events = Tables(spark, sf_dir).web_events.select("event", "value", "collector_tstamp")
    for part in _parts(events, 3):
        _deliver(spark, part, f"{folder}/in")
        figures = (
            _stream_of(spark, events, f"{folder}/in")
            .groupBy("event")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
        )
        streams.publish_stream(figures, table, ["event"], f"{folder}/progress").awaitTermination()
    return spark.table(table).select("event", "n", F.round("value", 4).alias("value"))


@query("stream_exact_sessions", "streamed_sessions")
def _(spark, sf_dir):
    """Three deliveries; events of the last half day of a delivery may come with the next one."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = Tables(spark, sf_dir).web_events
    at, late = F.unix_micros("collector_tstamp"), F.crc32("event_id") % 7 == 0
    ends = events.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    step = (ends["high"] - ends["low"]) // 3 + 1
    place = F.least(F.floor((at - ends["low"] + F.when(late, 43_200_000_000).otherwise(0)) / step), F.lit(2))
    last = F.timestamp_micros(F.lit(ends["high"]))
    # later events of nobody close all days
    named = {"domain_userid": "", "event_id": "none", "app_id": "web", "br_renderengine": "webkit"}
    nobody = events.limit(1).withColumns({c: F.lit(v) for c, v in named.items()})
    closing = [nobody.withColumn("collector_tstamp", last + F.expr(f"INTERVAL {d} DAYS")) for d in (30, 60)]
    for part in [*[events.filter(place == k) for k in range(3)], *closing]:
        _deliver(spark, part, f"{folder}/in")
        stream = _stream_of(spark, events, f"{folder}/in")
        write_exact_sessions(stream, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return (
        spark.read.parquet(f"{folder}/out")
        .filter("domain_userid <> ''")
        .select("session_id", "event_id", "collector_tstamp", "session_event_index", "is_external")
    )
