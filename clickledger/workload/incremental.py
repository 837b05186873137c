from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import channels
from ..plans import incremental as inc
from .marketing import adgroup_map
from .registry import Tables, query


def deliveries(events: DataFrame) -> list[DataFrame]:
    """The events in two deliveries; every seventh of the first one's time comes late, with the second."""
    at = F.col("collector_tstamp")
    middle = events.select(F.timestamp_micros(F.avg(F.unix_micros(at)).cast("long"))).scalar()
    first = F.coalesce((at < middle) & (F.crc32("event_id") % 7 != 0), F.lit(False))
    return [events.filter(first), events.filter(~first)]


def loaded(t: Tables, *jobs: Callable[[inc.Store], None]) -> inc.Store:
    """A store whose jobs have taken all events, delivery by delivery."""
    store = inc.Store(f"store_{uuid.uuid4().hex}", slots=8)
    for number, rows in enumerate(deliveries(t.web_events)):
        inc.land(rows, store, number)
        for job in jobs:
            job(store)
    return store


def _inputs(t: Tables) -> inc.Inputs:
    return inc.Inputs(t.click_report, adgroup_map(t), t.tv_peaks, t.iso_country_codes, t.user_map, t.utm_ids)


@query("incremental_equals_rebuild", "facts_of_sessions")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    inputs = _inputs(t)
    store = loaded(t, lambda s: inc.run(spark, s, inputs))
    return spark.table(store.table("sessions")).drop("berlin_day")


@query("incremental_session_map", "streamed_sessions")
def _(spark, sf_dir):
    store = loaded(Tables(spark, sf_dir), lambda s: inc.map_sessions(spark, s))
    return spark.table(store.table("session_map")).select(
        "session_id", "event_id", "collector_tstamp", "session_event_index", "is_external"
    )


@query("incremental_channels", "classified_channels")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    inputs = _inputs(t)
    store = loaded(t, lambda s: inc.load_channels(spark, s, inputs))
    return channels.channel_classify(spark.table(store.table("channel_prep")).drop("slot"))
