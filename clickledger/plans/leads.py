"""CRM leads -> lead dimension and the channels only leads know."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strip_special, to_did, to_int_code
from ..operators.loads import unseen
from ..operators.skew import lookup
from ..rules import leads as rules
from ..rules.channels import CHANNEL_GROUPS, HOUSE_BRAND
from ..rules.cities import city_of, city_style
from ..rules.ladder import mapped, part, rolled_up

PARTNER_LEADS_UNTIL = datetime(2016, 10, 1)


def first_last_touch(touches: DataFrame) -> DataFrame:
    """First and last agent of each lead with their times; the lead queue is nobody."""
    order = F.struct("lead_touchpoint_at", "agent_id")
    return (
        touches.filter(F.col("agent_id") != rules.LEAD_QUEUE)
        .groupBy("lead_id")
        .agg(
            F.min_by("agent_id", order).alias("first_agent"),
            F.max_by("agent_id", order).alias("last_agent"),
            F.min("lead_touchpoint_at").alias("first_touchpoint_at"),
            F.max("lead_touchpoint_at").alias("last_touchpoint_at"),
        )
    )


def _with_offers(leads: DataFrame, offers: DataFrame) -> DataFrame:
    """Each lead with each of its offers, or once with none."""
    offers = offers.select(
        F.col("sf_lead_id").alias("id"), "sf_opportunity_id", "sf_offer_id", "hb_lead_id", "qualified_at"
    )
    offered = lookup(offers, leads, ["id"], "inner")
    without = leads.join(offers.select("id").dropna().distinct(), "id", "left_anti")
    return offered.unionByName(without, allowMissingColumns=True)


def lead_dim(
    leads: DataFrame,
    offers: DataFrame,
    opportunities: DataFrame,
    touches: DataFrame,
    countries: DataFrame,
    conversions: DataFrame,
    sessions: DataFrame,
    as_of: datetime,
    changed: DataFrame | None = None,
    landing_pages: DataFrame | None = None,
    lead_scores: DataFrame | None = None,
    house_brand: str = HOUSE_BRAND
) -> DataFrame:
    """One row per lead: states, agents, place, marketing key, opportunity and conversion.

    A lead row counts if it is both the earliest qualified of its CRM id and of its lead id. Both
    ranks are minima taken before the shuffle, so neither a CRM id nor a lead id can fill a task.
    """
    calls = [c for c in leads.columns if re.fullmatch(r"call_[1-7]_timestamp", c)]
    counted = leads.filter(
        ~F.col("is_trainings_lead")
        & (
            (F.col("record_type_id") != rules.PARTNER_LEAD)
            | (F.col("created_date") < PARTNER_LEADS_UNTIL)
        )
    )
    own_id = F.col("backend_opportunity_id").try_cast("long")
    if changed is not None:
        keys = changed.select(F.col("lead_id").alias("_own"))
        counted = counted.withColumn("_own", own_id).join(keys, "_own", "left_semi").drop("_own")
    rows = _with_offers(counted, offers).withColumn(
        "lead_id", F.coalesce(F.col("hb_lead_id").cast("long"), own_id)
    )
    # NULL times last; the ids only make the choice repeatable
    order = F.struct(
        F.col("qualified_at").isNull().alias("open"), "qualified_at", "sf_opportunity_id", "id"
    )
    rows = rows.withColumn("_order", order)
    columns = [c for c in rows.columns if c != "id"]
    per_crm = (
        rows.groupBy("id")
        .agg(
            F.min_by(F.struct(*columns), "_order").alias("row"),
            F.count(F.lit(1)).alias("associated_opportunities_count"),
        )
        .select("id", "row.*", "associated_opportunities_count")
    )
    per_lead = (
        rows.filter(F.col("lead_id").isNotNull()).groupBy("lead_id").agg(F.min("_order").alias("_first"))
    )
    p = per_crm.join(per_lead, "lead_id").filter(F.col("_order") == F.col("_first"))

    places = countries.select(
        F.col("leads_country").alias("country"), F.col("opportunities_country").alias("_mapped")
    )
    p = lookup(p, places, ["country"])
    p = p.join(first_last_touch(touches), "lead_id", "left")
    o = opportunities.select(
        F.col("id").alias("sf_opportunity_id"),
        "sales_agent_lookup",
        F.col("created_date").alias("_qualified_at"),
        F.lower("opscancellationreason").like(rules.FAKE_BOOKING).alias("_fake"),
        F.col("job_country").alias("_job_country"),
        *[
            (F.col(f"mkt_{c}") if f"mkt_{c}" in opportunities.columns else F.lit(None).cast("string"))
            .alias(f"_o_{c}")
            for c in ("campaign", "source", "medium")
        ],
    )
    p = p.join(o, "sf_opportunity_id", "left")
    c = conversions.select(
        F.col("tr_orderid").try_cast("long").alias("lead_id"),
        "session_id",
        "conversion_type",
        "conversion_path_id",
        "onsite_conversion_locale_tstamp",
        "domain_userid",
        "onsite_user_id",
    )
    p = p.join(c, "lead_id", "left").join(
        sessions.select("session_id", "landing_pagepath"), "session_id", "left"
    )
    p = p.withColumn("_campaign", rules.campaign_of(F.col("lead_campaign")))
    if landing_pages is not None:
        pages = landing_pages.select(
            F.col("campaign").alias("_campaign"), F.col("landing_page").alias("_landing"), "is_spinfire"
        )
        p = lookup(p, pages, ["_campaign"])
    else:
        p = p.withColumns(
            {"_landing": F.lit(None).cast("string"), "is_spinfire": F.lit(None).cast("boolean")}
        )
    if lead_scores is not None:
        p = p.join(
            lead_scores.select(
                F.col("opportunity_id").try_cast("long").alias("hb_lead_id"),
                F.col("created_at").alias("lead_score_created_at"),
            ),
            "hb_lead_id",
            "left",
        )
    else:
        p = p.withColumn("lead_score_created_at", F.lit(None).cast("timestamp"))

    def lowered(name: str) -> Column:
        return F.coalesce(F.lower(name), F.lit(""))

    def optional(name: str) -> Column:
        return F.col(name) if name in p.columns else F.lit(None).cast("string")

    source = rules.source_of(F.col("source"), house_brand)
    internal = rules.is_internal_source(F.col("source"), house_brand)
    vertical = F.lower("main_vertical")
    vertical_id = to_int_code(vertical, 4)
    substatus, status = F.col("substatus"), F.col("status")
    wrong = substatus.like(rules.WRONG_DATA)
    valid = ~F.coalesce(substatus.isin(rules.INVALID_SUBSTATUS) | wrong, F.lit(False))
    reached = F.coalesce(substatus.isin(rules.UNREACHED_SUBSTATUS) | wrong, F.lit(True))
    real = ~F.coalesce(F.col("_fake"), F.lit(False))
    closed = status.isin(rules.CLOSED_STATUS)
    closed_at = F.coalesce("_qualified_at", F.when(closed, F.col("last_modified_date")))
    country = F.coalesce("_mapped", "job_country", F.lit(""))
    marketing = [
        F.coalesce(F.col(f"_o_{part_}"), lowered(f"mkt_{part_}"))
        for part_ in ("campaign", "source", "medium")
    ]
    has_opportunity = F.col("sf_offer_id").isNotNull().cast("smallint")
    return p.select(
        F.md5(F.concat(source, "_campaign", *marketing, vertical_id.cast("string"))).alias("utm_id"),
        "lead_id",
        F.col("id").alias("sf_lead_id"),
        F.col("lead_id").alias("lead_conversion_id"),
        F.coalesce("sales_agent_lookup", "owner_id").alias("agent_id"),
        F.coalesce("first_agent", "owner_id", "sales_agent_lookup").alias("first_agent_id"),
        F.coalesce("sales_agent_lookup", "last_agent", "owner_id").alias("last_agent_id"),
        F.col("created_date").alias("lead_created_at"),
        "first_touchpoint_at",
        "last_touchpoint_at",
        to_did(F.col("created_date")).alias("lead_created_did"),
        F.col("_qualified_at").alias("qualified_at"),
        to_did(F.col("_qualified_at")).alias("qualified_did"),
        closed_at.alias("lead_closed_at"),
        to_did(closed_at).alias("lead_closed_did"),
        F.col("lead_process_end").alias("lead_process_end_at"),
        to_did(F.col("lead_process_end")).alias("lead_process_end_did"),
        source.alias("lead_source"),
        F.col("_campaign").alias("lead_campaign"),
        *[lowered(f"mkt_{part_}").alias(f"mkt_{part_}") for part_ in ("source", "medium", "campaign")],
        F.coalesce("landing_pagepath", "_landing").alias("landing_page"),
        "is_spinfire",
        F.col("score").alias("lead_score"),
        F.col("price").alias("lead_price"),
        F.coalesce(F.lower(optional("source_id")), F.lit("")).alias("lead_source_id"),
        F.when(F.col("salutation") == "Mr.", "M")
        .when(F.col("salutation") == "Mrs.", "F")
        .alias("gender_customer"),
        F.left(
            F.trim(F.lower(F.concat(country, F.coalesce("job_city", "city", F.lit(""))))), F.lit(48)
        ).alias("geo_id"),
        F.left(
            F.concat(
                F.lower(country),
                strip_special(F.coalesce("postal_code", "job_postal_code", F.lit(""))),
            ),
            F.lit(48),
        ).alias("zip_id"),
        F.coalesce("_job_country", "_mapped").alias("country"),
        F.col("city").alias("lead_city"),
        F.col("postal_code").alias("lead_postal_code"),
        "session_id",
        "conversion_type",
        "conversion_path_id",
        "onsite_conversion_locale_tstamp",
        "domain_userid",
        "onsite_user_id",
        optional("duplicate_of").alias("duplicate_of"),
        rules.status_of(status).alias("status"),
        status.alias("raw_status"),
        "substatus",
        (valid & real).alias("is_valid_lead"),
        (valid & real).cast("int").alias("bin_valid_lead"),
        (reached & real).alias("is_reached_lead"),
        (reached & real).cast("int").alias("bin_reached_lead"),
        closed.alias("is_closed_lead"),
        (status == "Qualified").alias("is_qualified"),
        has_opportunity.alias("has_opportunity"),
        has_opportunity.alias("is_converted_lead"),
        optional("unqualified_reason").alias("unqualified_reason"),
        internal.cast("smallint").alias("is_internal_lead"),
        internal.cast("int").alias("bin_internal_lead"),
        closed.cast("int").alias("bin_closed_lead"),
        F.when(internal, "internal").otherwise("external").alias("sourcing_type"),
        vertical.alias("lead_main_vertical"),
        vertical_id.alias("primary_vertical_type_id"),
        *calls,
        F.lit(as_of).cast("timestamp").alias("etl_at"),
        "associated_opportunities_count",
        mapped(F.col("record_type_id"), rules.RECORD_TYPES, F.lit(None).cast("string")).alias(
            "record_type"
        ),
        "lead_score_created_at",
    )


def lead_channels(
    leads: DataFrame,
    channels: DataFrame,
    since: datetime | None = None,
    house_brand: str = HOUSE_BRAND,
) -> DataFrame:
    """Channel rows for lead keys the channel dimension lacks, from each key's earliest lead."""
    new = unseen(leads if since is None else leads.filter(F.col("lead_created_at") > since), channels, "utm_id")
    source, campaign = rules.lead_source_channel()
    prep = new.select(
        "utm_id",
        source.alias("source"),
        rules.lead_channel(house_brand).alias("channel"),
        F.coalesce(F.nullif("mkt_medium", F.lit("")), "lead_campaign").alias("medium"),
        campaign.alias("campaign"),
        F.col("primary_vertical_type_id").alias("vertical_type_id"),
        F.col("lead_main_vertical").alias("product"),
        "lead_created_at",
        "lead_id",
    )
    values = ["source", "channel", "medium", "campaign", "vertical_type_id", "product"]
    u = (
        prep.groupBy("utm_id")
        .agg(
            F.min_by(F.struct(*values), F.struct("lead_created_at", "lead_id")).alias("row"),
            F.max("lead_created_at").alias("updated_at"),
        )
        .select("utm_id", "row.*", "updated_at")
        .withColumns(
            {
                "mkt_subchannel": F.left(rules.lead_subchannel(house_brand), F.lit(32)),
                "city_style": city_style(F.col("campaign")),
                **{f"camp_{n}": part(F.col("campaign"), n) for n in range(1, 6)},
            }
        )
        .withColumn("is_new", F.col("camp_2").isin("de", "nl", "ac", "ch"))
    )
    groups = {name: subs for name, subs in CHANNEL_GROUPS.items()} | {
        "lead provider": ["lead provider"]
    }
    channel, new_style = F.col("channel"), F.col("is_new")
    external = channel == "lead provider"
    return u.select(
        "utm_id",
        F.left(channel, F.lit(24)).alias("channel"),
        "mkt_subchannel",
        F.left(rolled_up(F.col("mkt_subchannel"), groups, "unknown"), F.lit(22)).alias("mkt_channel"),
        F.when(channel.isin("lead provider", "inbound"), "external")
        .when(channel == "tv", "tv")
        .otherwise("web")
        .alias("mkt_medium"),
        "product",
        "vertical_type_id",
        F.left(channel, F.lit(32)).alias("medium"),
        F.left("source", F.lit(128)).alias("source"),
        F.left("source", F.lit(128)).alias("detailed_source"),
        F.lit("untracked").alias("referrer"),
        F.left("campaign", F.lit(128)).alias("campaign"),
        F.left("medium", F.lit(128)).alias("term"),
        F.lit(None).cast("string").alias("content"),
        F.col("medium").alias("refr_medium"),
        external.alias("is_lead_provider"),
        (~external).cast("int").alias("bin_internal"),
        "city_style",
        city_of(F.col("campaign"), F.col("city_style")).alias("city"),
        F.lit("na").alias("extended_city"),
        F.when(external, "ext").when(new_style, F.col("camp_1")).otherwise(F.col("camp_2")).alias("prefix"),
        F.when(new_style & F.col("camp_4").like("city%"), "city")
        .when(new_style, part(F.col("camp_4"), 1, "-"))
        .otherwise(F.col("camp_3"))
        .alias("push"),
        F.when(new_style, F.col("camp_5")).otherwise("na").alias("audience"),
        F.lit("na").alias("sub_audience"),
        F.lit("na").alias("campaign_date"),
        "updated_at",
    )
