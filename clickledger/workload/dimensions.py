from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import channels, dimensions, facts, leads, report, returns, spend
from ..rules.measures import MEASURES
from .marketing import ad_spend, attributed, channel_dimension, onsite, sheet_facts, visits
from .registry import Tables, query

AS_OF = datetime(2024, 2, 1)


def lead_dim(t: Tables) -> DataFrame:
    return leads.lead_dim(
        t.crm_leads,
        t.opportunity_offers,
        t.crm_opportunities,
        t.agent_touches,
        t.country_mapping,
        onsite(t),
        visits(t),
        AS_OF,
    )


def dimension(t: Tables) -> DataFrame:
    return t.step("channels", channel_dimension)


@query("first_last_touch", "touches")
def _(spark, sf_dir):
    return leads.first_last_touch(Tables(spark, sf_dir).agent_touches)


@query("lead_dim", "leads_dim")
def _(spark, sf_dir):
    return lead_dim(Tables(spark, sf_dir))


@query("lead_channels", "lead_only_channels")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return leads.lead_channels(lead_dim(t), dimension(t))


@query("vertical_cross", "vertical_crossed")
def _(spark, sf_dir):
    return dimensions.vertical_cross(Tables(spark, sf_dir).verticals)


@query("vertical_dim", "vertical_types")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    names = [dimension(t).select("product"), lead_dim(t).select("lead_main_vertical")]
    return dimensions.vertical_dim(t.verticals, names)


@query("geo_dim", "places")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    crm = t.crm_leads.join(
        t.country_mapping.withColumnRenamed("leads_country", "country"), "country", "left"
    )
    partners = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    c = F.col
    feeds = [
        crm.select(
            *dimensions.geo_feed(
                F.coalesce("opportunities_country", "job_country"), F.coalesce("job_city", "city")
            )
        ),
        t.crm_opportunities.select(*dimensions.geo_feed(c("job_country"), c("job_city"))),
        partners.select(*dimensions.geo_feed(c("n_name"), c("s_name"))),
        visits(t).select(
            *dimensions.geo_feed(c("country"), c("city"))
        ),
    ]
    return dimensions.geo_dim(feeds)


def returned(t: Tables) -> DataFrame:
    """Attributed returns as rows of the marketing fact."""
    return t.step("return_facts", lambda t: returns.return_facts(attributed(t), dimension(t)))


def spent(t: Tables) -> DataFrame:
    """Advertising cost as rows of the marketing fact."""
    rows = t.step("ad_spend", ad_spend)
    return t.step("spend_facts", lambda t: spend.spend_facts(rows, channels.channel_classify(rows)))


def feed(t: Tables, table: str) -> None:
    """All jobs that write the marketing fact."""
    facts.load_costs(facts.visit_facts(visits(t)), table, facts.VISITS)
    facts.load_returns(returned(t), table)
    facts.load_costs(spent(t), table, facts.SPEND, tail_only=True)
    facts.load_costs(sheet_facts(t), table, facts.SHEET)


@query("marketing_facts", "marketing_fact")
def _(spark, sf_dir):
    """The fact after an earlier load with other values, of which no row may be left."""
    t = Tables(spark, sf_dir)
    table = f"facts_{uuid.uuid4().hex}"
    facts.create(spark, table)
    early = returned(t).filter("lead_id % 3 > 0")
    # leads, cost and sheet as they were known before: other values, other days, other keys
    facts.load_returns(early.withColumns({"cost": F.col("cost") + 1, "date_id": F.col("date_id") + F.col("lead_id") % 5}), table)
    before = spent(t)
    facts.load_costs(before.withColumn("cost", F.col("cost") * 2), table, facts.SPEND, tail_only=True)
    later = before.withColumn("date_id", F.col("date_id") + 400)
    facts.load_costs(later, table, facts.SPEND, tail_only=True)
    facts.load_costs(sheet_facts(t).withColumn("date_id", F.col("date_id") - 1), table, facts.SHEET)
    feed(t, table)
    values = ["cost", *MEASURES, *[f"lc_{m}" for m in MEASURES]]
    return spark.table(table).drop("fact_month").withColumns({c: F.round(c, 6) for c in values})


@query("cumulative_marketing", "cumulative")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    table = f"facts_{uuid.uuid4().hex}"
    facts.create(spark, table)
    feed(t, table)
    days = t.step("dates", lambda t: facts.date_dimension(spark))
    result = report.cumulative_marketing(spark.table(table), dimension(t), days, date(2024, 2, 1))
    rounded = ["valid_leads", "cost"] + [
        f"{kind}_{v}" for kind in ("cumulative", "lag") for v in report.VALUES
    ]
    return result.withColumns(
        {
            "date": F.col("date").cast("string"),
            "month": F.col("month").cast("string"),
            **{c: F.round(c, 4) for c in rounded},
        }
    )
