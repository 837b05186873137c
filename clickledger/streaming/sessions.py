"""Sessions of an event stream by the exact break rules, with state and timers per user."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import BERLIN, berlin_local
from ..plans.sessions import countable_events, keep_known

KEY = "event_id string, event_fingerprint string"
EVENT = (
    "collector_micros bigint, derived_micros bigint, domain_sessionid string, locale_date string, day_end bigint, "
    "entrance_id string"
)
SESSIONS = (
    "session_id string, event_id string, event_fingerprint string, collector_micros bigint, domain_userid string, "
    "session_event_index bigint, is_external boolean"
)
_FIELDS = [part.split()[0] for part in f"{KEY}, {EVENT}".split(", ")]
_DAY_END = _FIELDS.index("day_end")
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sessions_of_day(events: list[tuple]) -> list[tuple]:
    """Session id, event, fingerprint, time, position and origin of one user's events of one day, in order of time.

    `events`: (event_id, event_fingerprint) and the fields of EVENT. The first event of a tracker session opens a session, as
    does an entrance other than the last one.
    """
    out, seen, entrance, session, position = [], set(), None, None, 0
    for key, event in sorted(events, key=lambda e: (e[1][0], e[1][1] is not None, e[1][1] or 0, *e[0])):
        micros, _, tracker, day, _, own = event
        opens = tracker not in seen
        seen.add(tracker)
        if opens or own is not None:
            name = own or "direct_or_time"
            if opens or name != entrance:
                session, position = f"{day}_{key[0]}", 0
            entrance = name
        position += 1
        out.append((session, *key, micros, position, own is not None))
    return out


def newest_copies(events: Iterable[tuple]) -> dict[tuple, tuple]:
    """The newest copy of each event, of equally new ones the last to arrive. `events`: EVENT after KEY, as they arrived."""
    newest: dict[tuple, tuple] = {}
    for event in events:
        name, fields = tuple(event[:2]), tuple(event[2:])
        held = newest.get(name)
        if held is None or (held[0], held[1] or 0) <= (fields[0], fields[1] or 0):
            newest[name] = fields
    return newest


class DaySessions(StatefulProcessor):
    """Holds a user's events until the watermark passes the Berlin day of their newest copy.

    Arrivals are appended in one call for each user and batch. A timer at the first open day's end closes all days that the watermark
    has passed by then, so a user's state is read once for each batch that closes some day, however many days or events it holds.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", f"{KEY}, {EVENT}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        arrived = [tuple(row[f] for f in _FIELDS) for row in rows]
        self.events.appendList(arrived)
        self.handle.registerTimer(min(event[_DAY_END] for event in arrived))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        closed: dict[int, list[tuple]] = {}
        held = []
        # another timer of the batch may have emptied the state
        for name, fields in newest_copies(self.events.get() if self.events.exists() else ()).items():
            end = fields[_DAY_END - 2]
            if end <= passed:
                closed.setdefault(end, []).append((name, fields))
            else:
                held.append((*name, *fields))
        if held:
            self.events.put(held)
            self.handle.registerTimer(min(event[_DAY_END] for event in held))
        else:
            self.events.clear()
        for end in sorted(closed):
            for session, event, fingerprint, micros, position, external in sessions_of_day(closed[end]):
                yield Row(
                    session_id=session, event_id=event, event_fingerprint=fingerprint, collector_micros=micros,
                    domain_userid=key[0], session_event_index=position, is_external=external,
                )

    def close(self) -> None:
        pass


def exact_sessions(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """The event -> session map of a stream. A day's sessions come when the watermark has passed its end.

    Events of a day that is closed already are late and left out, as by any watermark. Copies of an event shrink to the newest
    one that arrived before its day closed. State holds the open days of each user.
    """
    day = F.to_date(berlin_local(F.col("collector_tstamp")))
    hits = countable_events(events).filter(F.col("collector_tstamp").isNotNull()).select(
        F.left("event_id", F.lit(36)).alias("event_id"),
        F.left("event_fingerprint", F.lit(128)).alias("event_fingerprint"),
        F.left("domain_userid", F.lit(36)).alias("domain_userid"),
        "domain_sessionid",
        "collector_tstamp",
        F.unix_micros("collector_tstamp").alias("collector_micros"),
        F.unix_micros("derived_tstamp").alias("derived_micros"),
        F.date_format(berlin_local(F.col("collector_tstamp")), "yyyyMMdd").alias("locale_date"),
        F.unix_millis(F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), BERLIN)).alias("day_end"),
        F.when(
            keep_known("refr_medium", "internal"),
            F.md5(F.lower(F.concat(F.coalesce("page_url", F.lit("")), F.coalesce("page_referrer", F.lit(""))))),
        ).alias("entrance_id"),
    )
    found = (
        hits.withWatermark("collector_tstamp", lateness)
        .groupBy("domain_userid")
        .transformWithState(DaySessions(), SESSIONS, "Append", "EventTime")
    )
    return found.select(
        "session_id",
        "event_id",
        "event_fingerprint",
        F.timestamp_micros("collector_micros").alias("collector_tstamp"),
        "domain_userid",
        "session_event_index",
        "is_external",
    )


def write_exact_sessions(events: DataFrame, target: str, checkpoint: str, lateness: str = "1 day") -> StreamingQuery:
    """Append the closed days' sessions to a folder, one bounded run over all that is new."""
    conf, key = events.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    # timers and list state need this store; a query keeps the setting it was started with
    conf.set(key, _ROCKSDB)
    try:
        return (
            exact_sessions(events, lateness)
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(target)
        )
    finally:
        conf.set(key, before)
