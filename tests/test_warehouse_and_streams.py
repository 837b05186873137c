import random
import uuid

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from clickledger.plans.incremental import Store
from clickledger.plans.sessions import sessionize
from clickledger.session import shared_dir
from clickledger.sources import warehouse
from clickledger.streaming.events import publish_stream, sessionize_stream, timeout_windows, without_copies
from clickledger.streaming.sessions import DaySessions, write_exact_sessions

from .conftest import EVENT_SCHEMA, make_events, rows, same, values


def name():
    return f"t_{uuid.uuid4().hex[:8]}"


def test_swap_reads_its_own_table(spark):
    table = name()
    warehouse.rebuild(spark.range(3), table)
    warehouse.swap_in(spark.table(table).filter("id > 0").withColumn("x", F.lit("new")), table)
    assert values(spark.table(table), "id", "id") == [1, 2]
    assert warehouse.read_query(spark, f"SELECT count(*) AS n FROM {table}").first().n == 2


def test_readers_of_the_version_before_go_on(spark):
    table = name()
    for n in range(1, 6):
        begun = spark.table(table) if n > 1 else None
        warehouse.swap_in(spark.range(n), table)
        assert begun is None or begun.count() == n - 1
        assert spark.table(table).count() == n
    assert len(warehouse._versions(spark, table)) == 2
    warehouse.drop_versions(spark, table)
    assert not spark.catalog.tableExists(table) and warehouse._versions(spark, table) == []


def test_slice_overwrites_only_its_partitions(spark):
    table = name()
    facts = spark.createDataFrame([(1, "lead"), (2, "mkt_spend")], "v int, fact_subtype string")
    warehouse.rebuild(facts, table, ["fact_subtype"])
    stage = spark.createDataFrame([("mkt_spend", 7), ("mkt_spend", 8)], "fact_subtype string, v int")
    warehouse.write_slice(stage, table, "fact_subtype", "mkt_spend")
    assert values(spark.table(table), "v", "v") == [1, 7, 8]
    warehouse.write_slice(stage.filter("false"), table, "fact_subtype", "mkt_spend")
    assert values(spark.table(table), "v", "v") == [1]


@pytest.mark.parametrize("plain", [True, False])
@pytest.mark.parametrize("cut", range(8))
def test_a_swap_cut_off_at_any_step_shows_old_or_new(spark, monkeypatch, plain, cut):
    """Each statement of a swap fails once, before it takes effect; a reader always finds all of one content."""
    table = name()
    if plain:
        warehouse.rebuild(spark.range(2), table)
    else:
        for n in (9, 2):
            warehouse.swap_in(spark.range(n), table)
    steps = []

    def dying(step):
        def run(*args, **kwargs):
            steps.append(step.__name__)
            if len(steps) == cut + 1:
                raise RuntimeError("lost")
            return step(*args, **kwargs)

        return run

    class Session:
        catalog = spark.catalog
        conf = spark.conf

        def sql(self, text, **kwargs):
            return dying(spark.sql)(text, **kwargs)

        table = staticmethod(spark.table)

    class Rows:
        sparkSession = Session()
        write = spark.range(5).write

    monkeypatch.setattr(warehouse, "rebuild", dying(warehouse.rebuild))
    try:
        warehouse.swap_in(Rows(), table)
        died = False
    except RuntimeError:
        died = True
    monkeypatch.undo()
    assert died == (cut < len(steps))
    if not spark.catalog.tableExists(table):
        # only a plain table's first swap leaves its name for a moment
        assert plain
        warehouse.recover(spark, table)
    assert spark.table(table).count() in (2, 5)
    warehouse.swap_in(spark.range(7), table)
    assert spark.table(table).count() == 7 and len(warehouse._versions(spark, table)) <= 3


def test_publish_audits_each_table(spark):
    good, bad = name(), name()

    def broken():
        raise ValueError("no data")

    audit = rows(warehouse.publish({good: lambda: spark.range(4), bad: broken}, spark), "is_error")
    assert [(r["rs_table"], r["is_error"], r["rows_processed"]) for r in audit] == [(good, 0, 4), (bad, 1, 0)]
    assert audit[1]["error_message"] == "no data"
    assert "loaded_at" in spark.table(good).columns


def stream_of(spark, folder):
    return spark.readStream.schema(EVENT_SCHEMA).parquet(folder)


def deliver(folder, events):
    events.coalesce(1).write.mode("append").parquet(folder)


FIRST = [
    {"at": "2024-01-10 10:00:00", "event_id": "a"},
    {"at": "2024-01-10 10:20:00", "event_id": "b"},
    {"at": "2024-01-11 10:00:00", "event_id": "c"},
    {"at": "2024-01-11 10:00:05", "event_id": "c"},
]
LATE = [
    {"at": "2024-01-10 10:10:00", "event_id": "d", "refr_medium": "search"},
    {"at": "2024-01-12 09:00:00", "event_id": "e"},
]


def test_late_events_in_a_stream_end_like_a_batch(spark, tmp_path):
    store, paths = Store(name(), slots=2), [str(tmp_path / p) for p in ("in", "progress")]
    for delivery in (FIRST, LATE):
        deliver(paths[0], make_events(spark, *delivery))
        sessionize_stream(stream_of(spark, paths[0]), store, paths[1]).awaitTermination()
    keep = ["session_id", "event_id", "collector_tstamp", "session_event_index", "is_external"]
    spark.catalog.refreshTable(store.table("session_map"))
    streamed = spark.table(store.table("session_map")).select(*keep)
    assert same(streamed, sessionize(make_events(spark, *FIRST, *LATE)).select(*keep))
    assert dict(zip(values(streamed, "event_id", "event_id"), values(streamed, "session_id", "event_id")))["b"] == "20240110_d"


def test_a_copy_on_a_later_day_moves_its_event(spark, tmp_path):
    store, paths = Store(name(), slots=2), [str(tmp_path / p) for p in ("in", "progress")]
    deliveries = [
        [{"at": "2024-01-10 10:00:00", "event_id": "a"}, {"at": "2024-01-10 11:00:00", "event_id": "b"}],
        [{"at": "2024-01-11 10:00:00", "event_id": "a"}, {"at": "2024-01-12 10:00:00", "event_id": "c"}],
        [{"at": "2024-01-13 10:00:00", "event_id": "a"}, {"at": "2024-01-10 12:00:00", "event_id": "d"}],
    ]
    for delivery in deliveries:
        deliver(paths[0], make_events(spark, *delivery))
        sessionize_stream(stream_of(spark, paths[0]), store, paths[1]).awaitTermination()
    keep = ["session_id", "event_id", "collector_tstamp", "session_event_index", "is_external"]
    spark.catalog.refreshTable(store.table("session_map"))
    streamed = spark.table(store.table("session_map")).select(*keep)
    assert same(streamed, sessionize(make_events(spark, *sum(deliveries, []))).select(*keep))


def run_to_table(spark, stream, tmp_path, mode="append"):
    out = str(tmp_path / name())
    (stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", out + "_p")
     .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.parquet(out)


def test_stream_keeps_the_first_copy(spark, tmp_path):
    deliver(str(tmp_path / "in"), make_events(spark, *FIRST))
    out = run_to_table(spark, without_copies(stream_of(spark, str(tmp_path / "in"))), tmp_path)
    assert values(out, "event_id", "event_id") == ["a", "b", "c"]


def test_stream_timeout_windows(spark, tmp_path):
    later = {"at": "2024-01-20 00:00:00", "event_id": "z"}
    deliver(str(tmp_path / "in"), make_events(spark, *FIRST, later))
    deliver(str(tmp_path / "in"), make_events(spark, {"at": "2024-01-25 00:00:00", "event_id": "y"}))
    out = run_to_table(spark, timeout_windows(stream_of(spark, str(tmp_path / "in"))), tmp_path)
    assert [r["events"] for r in rows(out, "start_at")][:2] == [2, 2]


def test_published_stream(spark, tmp_path):
    table = name()
    for delivery, total in ((FIRST, {"page_view": 4}), (LATE, {"page_view": 6}), ([{"at": "2024-01-12 09:00:00", "event": None}], {"page_view": 6, None: 1})):
        deliver(str(tmp_path / "in"), make_events(spark, *delivery))
        figures = stream_of(spark, str(tmp_path / "in")).groupBy("event").count()
        query = publish_stream(figures, table, ["event"], str(tmp_path / "p"))
        query.awaitTermination()
        got = rows(spark.table(table))
        assert {r["event"]: r["count"] for r in got} == total and all(r["loaded_at"] for r in got)
        # each run reads its own rows only
        assert sum(p["numInputRows"] for p in query.recentProgress) == len(delivery)


def day_events(seed):
    """Events of few users with tracker sessions, entrances, equal times and copies."""
    draw, given = random.Random(seed), []
    for i in range(60):
        at = f"2024-01-{draw.choice([10, 11, 12])} {draw.choice([8, 9, 22, 23]):02}:{draw.randint(0, 59):02}:00"
        given.append({
            "at": at, "event_id": f"e{i}", "domain_userid": draw.choice("uv"), "domain_sessionid": draw.choice(["s", "t", None]),
            "refr_medium": draw.choice(["internal", "internal", "search", None]), "page_referrer": draw.choice(["r1", "r2", None]),
        })
        if i % 9 == 0:
            given.append(given[-1] | {"at": "2024-01-12 23:59:00"})
    return given


@pytest.mark.parametrize("seed", range(3))
def test_exact_sessions_of_a_stream_end_like_a_batch(spark, tmp_path, seed):
    given = day_events(seed)
    closing = [[{"at": f"2024-0{m}-01 00:00:00", "event_id": "end", "domain_userid": "nobody"}] for m in (3, 4)]
    # out of order within a delivery, and a delivery that comes late but before its day is closed
    given.sort(key=lambda e: e["at"])
    for delivery in (given[0::2], given[1::2], *closing):
        deliver(str(tmp_path / "in"), make_events(spark, *delivery))
        stream = stream_of(spark, str(tmp_path / "in"))
        write_exact_sessions(stream, str(tmp_path / "out"), str(tmp_path / "p"), lateness="3 days").awaitTermination()
    keep = ["session_id", "event_id", "event_fingerprint", "collector_tstamp", "domain_userid", "session_event_index", "is_external"]
    streamed = spark.read.parquet(str(tmp_path / "out")).filter("domain_userid <> 'nobody'").select(*keep)
    assert same(streamed, sessionize(make_events(spark, *given)).select(*keep))


def test_steps_need_a_shared_folder_off_local_masters(spark, monkeypatch):
    class Far:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "spark://far:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Far)


class CountedState:
    """A user's list state, timers and the calls that reach them."""

    def __init__(self):
        self.held, self.timers, self.calls = [], set(), 0

    def getListState(self, name, schema):
        return self

    def __getattr__(self, name):
        def call(*values):
            self.calls += 1
            if name == "appendList":
                self.held += values[0]
            elif name in ("put", "clear"):
                self.held = list(values[0]) if values else []
            elif name == "registerTimer":
                self.timers.add(values[0])
            return {"get": iter(list(self.held)), "exists": bool(self.held)}.get(name)

        return call


def test_calls_to_the_stream_state_do_not_grow_with_events_and_days():
    def arrival(i, micros, day):
        return Row(event_id=f"e{i}", event_fingerprint="f", collector_micros=micros, derived_micros=None, domain_sessionid="s",
                   locale_date=f"d{day}", day_end=day * 1000, entrance_id=None)

    state, job = CountedState(), DaySessions()
    job.init(state)
    # 40 days of 10 events; the first event of a day has a newer copy on the next day
    given = [arrival(day * 10 + i, day * 1000 + i, day) for day in range(1, 41) for i in range(10)]
    given += [arrival(day * 10, (day + 1) * 1000 - 1, day + 1) for day in range(1, 40)]
    list(job.handleInputRows(("u",), iter(given), None))
    now = type("Timers", (), {"getCurrentWatermarkInMs": lambda self: 20_000})()
    out = list(job.handleExpiredTimer(("u",), now, None))
    assert state.calls < 10
    assert len(out) == 199 and len({r["event_id"] for r in out}) == 199
    # the copies of day 20 lie on day 21, which is open
    assert {e[0] for e in state.held} == {"e200"} | {f"e{i}" for i in range(210, 410)}
    assert state.timers == {1000, 21_000}
