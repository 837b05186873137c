from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import loads
from ..plans import repairs
from ..sources import warehouse
from ..sources.warehouse import snapshot
from .marketing import onsite
from .registry import Tables, query

CUT = datetime(2024, 1, 20)


def target_and_stage(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Loaded rows before a cut, and a changed delivery that starts a day before it."""
    rows = t.web_events.select(
        "event_id", "collector_tstamp", "domain_userid", "event", "value"
    )
    at = F.col("collector_tstamp")
    stage = rows.filter(at >= F.lit(CUT) - F.expr("INTERVAL 1 DAY"))
    return rows.filter(at < F.lit(CUT)), stage.withColumn("value", F.col("value") + 1000)


@query("upsert_by_key", "upserted")
def _(spark, sf_dir):
    return loads.upsert_by_key(*target_and_stage(Tables(spark, sf_dir)), "event_id")


@query("replace_tail", "tail_replaced")
def _(spark, sf_dir):
    return loads.replace_tail(*target_and_stage(Tables(spark, sf_dir)), "collector_tstamp")


@query("append_unseen", "unseen_appended")
def _(spark, sf_dir):
    return loads.append_unseen(*target_and_stage(Tables(spark, sf_dir)), "event_id")


@query("replace_slice", "slice_replaced")
def _(spark, sf_dir):
    target, stage = target_and_stage(Tables(spark, sf_dir))
    orders = stage.filter(F.col("event") == "tr")
    return loads.replace_slice(target, orders, "event", "tr", since="collector_tstamp")


@query("incremental_window", "window_of_run")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    target, _ = target_and_stage(t)
    start, end = loads.window_bounds(target, "collector_tstamp", t.load_log, "events_start")
    at = F.col("collector_tstamp")
    return t.web_events.filter((at >= start) & (at <= end)).select("event_id", "collector_tstamp")


@query("changed_keys", "changed")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    loaded = t.load_log.select(F.lit(CUT).alias("etl_at"))
    known = t.crm_leads.select(F.col("id").alias("legacy_lead_id"), F.col("backend_opportunity_id").alias("lead"))
    # an opportunity names its lead by the id it has in the CRM; the lead tells its number
    opportunities = t.crm_opportunities.join(known.dropna().distinct(), "legacy_lead_id")
    feeds = [
        (opportunities, "lead", "last_modified_date"),
        (onsite(t), "tr_orderid", "collector_tstamp"),
        (t.crm_leads, "backend_opportunity_id", "last_modified_date"),
    ]
    return loads.changed_keys(feeds, loaded, "etl_at", "3 HOURS")


@query("url_repair", "repaired_urls")
def _(spark, sf_dir):
    even = F.col("event_id").cast("int") % 2 == 0
    events = Tables(spark, sf_dir).web_events.select(
        "event_id",
        "collector_tstamp",
        "page_url",
        F.when(even, "https:").alias("page_urlscheme"),
        "page_urlhost",
    )
    return repairs.url_repair(events).drop("collector_tstamp")


@query("url_parts", "page_parts")
def _(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages
    parts = repairs.url_parts(F.col("url"))
    return pages.select("page_id", *[value.alias(name) for name, value in parts.items()])


@query("utm_backfill", "utm_filled")
def _(spark, sf_dir):
    return repairs.utm_backfill(Tables(spark, sf_dir).web_events).select(
        "event_id", *repairs.UTM_PARAMETERS
    )


@query("timestamp_normalise", "stamps")
def _(spark, sf_dir):
    raw = Tables(spark, sf_dir).raw_stamps
    return repairs.timestamp_normalise(raw, "raw_value").drop("props")


@query("props_extract", "props")
def _(spark, sf_dir):
    raw = Tables(spark, sf_dir).raw_stamps.select("event_id", "props")
    rows = repairs.props_extract(raw, "props", "k", "k")
    return repairs.props_extract(rows, "props", "none", "missing").drop("props")


def _orders_with_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.join(lines, "o_orderkey").withColumn("key", F.col("o_orderkey").cast("string"))


@query("distinct_sum", "order_sums")
def _(spark, sf_dir):
    rows = _orders_with_lines(Tables(spark, sf_dir))
    sums = repairs.distinct_sum(rows, ["o_orderstatus"], "o_totalprice", "key")
    return sums.withColumn("total", F.round("total", 2))


@query("distinct_sum_hashed", "order_sums")
def _(spark, sf_dir):
    rows = _orders_with_lines(Tables(spark, sf_dir))
    sums = repairs.hashed_distinct_sum(rows, ["o_orderstatus"], "o_totalprice", "key")
    return sums.withColumn("total", F.round("total", 2))


@query("snapshot_publish", "snapshots")
def _(spark, sf_dir):
    figures = (
        Tables(spark, sf_dir)
        .web_events.groupBy("event")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))
    )
    return snapshot(figures, F.lit(datetime(2024, 2, 1)))


def _table() -> str:
    return f"loading_{uuid.uuid4().hex}"


def _kinds(t: Tables) -> DataFrame:
    return t.web_events.select("event_id", "event", "value")


@query("read_query", "events_by_kind")
def _(spark, sf_dir):
    name = _table()
    warehouse.rebuild(_kinds(Tables(spark, sf_dir)), name)
    return warehouse.read_query(
        spark, f"SELECT event, count(*) AS n, round(sum(value), 4) AS value FROM {name} GROUP BY event"
    )


@query("rebuild_table", "views_only")
def _(spark, sf_dir):
    """A rebuilt table has its new content and columns only."""
    name, rows = _table(), _kinds(Tables(spark, sf_dir))
    warehouse.rebuild(rows.drop("value"), name)
    warehouse.rebuild(rows.filter(F.col("event") == "page_view"), name, ["event"])
    return spark.table(name).select("event_id", "event", "value")


@query("swap_table", "views_only")
def _(spark, sf_dir):
    """Rows computed from the table that they replace."""
    name = _table()
    warehouse.rebuild(_kinds(Tables(spark, sf_dir)), name)
    warehouse.swap_in(spark.table(name).filter(F.col("event") == "page_view"), name)
    return spark.table(name)


@query("slice_table", "slices")
def _(spark, sf_dir):
    """One slice gets other rows, one is cleared by an empty stage, the others stay."""
    name, rows = _table(), _kinds(Tables(spark, sf_dir)).filter(F.col("event").isNotNull())
    warehouse.rebuild(rows, name, ["event"])
    orders = rows.filter(F.col("event") == "tr").withColumn("value", F.col("value") * 2)
    warehouse.write_slice(orders, name, "event", "tr")
    warehouse.write_slice(rows.filter("false"), name, "event", "transaction")
    return spark.table(name).select("event_id", "event", F.round("value", 4).alias("value"))


@query("audit_rows", "audited")
def _(spark, sf_dir):
    """One table is published, the other fails; both leave an audit row."""
    t = Tables(spark, sf_dir)
    good, bad = _table(), _table()
    audit = warehouse.publish(
        {good: lambda: _kinds(t), bad: lambda: t.web_events.select("no_such_column")}, spark
    )
    return audit.select(
        "event_type", "event_category", "is_error", "rows_processed", "is_etl",
        (F.col("rs_table") == good).alias("is_good"),
        F.col("error_message").contains("no_such_column").alias("names_the_fault"),
    )
