"""Lead states, sources and the channel ladder for leads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .channels import HOUSE_BRAND, HOUSE_BRAND_PREFIX, LEAD_PROVIDERS
from .ladder import any_of, ladder, mapped, part

# Ids and words of the CRM at hand; replace them by those of another one.
LEAD_QUEUE = "lead-queue"
PARTNER_LEAD = "record-partner-lead"
RECORD_TYPES = {
    PARTNER_LEAD: "Partner Lead",
    "record-lead": "Lead",
    "record-customer": "Existing Customer",
}
INVALID_SUBSTATUS = ["Duplicate", "Fake request"]
UNREACHED_SUBSTATUS = [*INVALID_SUBSTATUS, "Expired in lead queue"]
WRONG_DATA = "Wrong data%"
FAKE_BOOKING = "fake booking%"
CLOSED_STATUS = ["Qualified", "Unqualified"]


def status_of(status: Column) -> Column:
    lowered = F.lower(status)
    return ladder(
        [
            ("duplicate", status == "Dublicate"),
            ("new", (status == "Untouched") | (lowered == "not contacted")),
            ("unqualified", lowered == "not interested"),
            ("in progress", status.like("___ Call%")),
        ],
        lowered,
    )


def is_internal_source(source: Column, house_brand: str = HOUSE_BRAND) -> Column:
    inside = [f"{house_brand} - intern", house_brand, f"{house_brand} -intern", "referral (intern)"]
    return F.coalesce(F.lower(source), F.lit("")).isin(inside)


def source_of(
    source: Column, house_brand: str = HOUSE_BRAND, prefix: str = HOUSE_BRAND_PREFIX
) -> Column:
    own = F.lower(source).startswith(prefix) | (source == "Referral (intern)")
    return F.when(own, house_brand).otherwise(F.coalesce(F.lower(source), F.lit("")))


def campaign_of(campaign: Column) -> Column:
    lowered = F.lower(campaign)
    return mapped(lowered, {"n/a": "na", "": "na"}, F.coalesce(lowered, F.lit("")))


def starts(campaign: Column, *prefixes: str) -> Column:
    return any_of([campaign.like(f"{p}%") for p in prefixes])


def lead_source_channel() -> tuple[Column, Column]:
    """Source and coarse channel of a lead from its marketing fields."""
    campaign, source = F.col("mkt_campaign"), F.col("mkt_source")
    origin = F.col("lead_source")
    found = ladder(
        [
            (source, source != ""),
            ("google", starts(campaign, "gsc", "gaw", "gmb")),
            ("bing", starts(campaign, "ba")),
            ("social paid", starts(campaign, "sp")),
            ("social organic", starts(campaign, "so")),
            ("crm", starts(campaign, "crm")),
        ],
        origin,
    )
    return found, campaign


def lead_channel(house_brand: str = HOUSE_BRAND) -> Column:
    campaign, source = F.col("mkt_campaign"), F.col("mkt_source")
    return ladder(
        [
            ("brand", starts(campaign, "gsc")),
            ("paid search", starts(campaign, "sn", "gaw", "ba", "gmb")),
            ("native", source.isin("taboola", "ligatus", "yahoo")),
            ("retargeting", source.like("smt%")),
            ("social paid", starts(campaign, "sp", "fb")),
            ("social organic", starts(campaign, "so")),
            ("crm", starts(campaign, "crm")),
            ("internal", F.col("lead_source") == house_brand),
            ("inbound", F.col("lead_source") == "inbound call"),
        ],
        "lead provider",
    )


def lead_subchannel(house_brand: str = HOUSE_BRAND) -> Column:
    """The channel ladder for leads. All 'ba' campaigns end in 'paid search google'."""
    campaign, source, medium = F.col("campaign"), F.col("source"), F.col("medium")
    brand, crm = starts(campaign, "gsc"), starts(campaign, "crm")
    kind = part(campaign, 4)
    sociomantic = (source == "smt") | starts(campaign, "smt")
    return ladder(
        [
            ("paid brand bing", brand & (source == "bing")),
            ("paid brand google", brand & (source == "google")),
            ("paid brand fcbk", brand & (source == "facebook")),
            ("display remarketing google", starts(campaign, "dis") & (kind == "remarketing")),
            ("display acquisition google", starts(campaign, "dis") & (kind == "acquisition")),
            ("paid search google", starts(campaign, "sn", "gaw", "ba", "gmb")),
            ("taboola", source == "taboola"),
            ("ligatus", source == "ligatus"),
            ("yahoo", source == "yahoo"),
            ("display retargeting sociomantic", sociomantic & kind.like("retarget%")),
            ("display acquisition sociomantic", sociomantic & (kind == "acquisition")),
            ("social paid fcbk", starts(campaign, "sp", "fb")),
            ("social organic fcbk", starts(campaign, "so")),
            (
                "transactional partner email",
                crm & (medium == "transactional") & (part(campaign, 5) == "partner"),
            ),
            ("transactional customer email", crm & (medium == "transactional")),
            ("marketing email", crm),
            ("inbound", source == "inbound call"),
            ("lead provider", source.isin(LEAD_PROVIDERS)),
            ("internal", source == house_brand),
        ],
        "uncaught utms",
    )
