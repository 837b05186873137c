"""Referrers, campaign codes and the channel ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cities import city_of
from .ladder import any_of, ladder, mapped, part, rolled_up

# The company's own name as it stands in campaign codes, lead sources and ad account names.
HOUSE_BRAND = "housebrand"
# how the brand's own lead sources begin
HOUSE_BRAND_PREFIX = "housebrand"

# Referrers that are no visit from outside (CRM, payment, sign-in).
EXCLUDED_HOSTS = [
    "eu6.sale%",
    "c.eu6.vis%",
    "c.cs84.vis%",
    "eu6.ligh%",
    "na39.sale%",
    "na35.sale%",
]
EXCLUDED_REFERRERS = [
    "https://www.paypal%",
    "hooks.stripe%",
    "https://www.facebook.com/v2.2/dialog/oauth%",
    "https://www.facebook.com/login.php%",
    "https://m.facebook.com/login.php%",
    "https://free.facebook.com/%",
]
# Host patterns per referrer name; '_' stands for one character.
HOST_NAMES = [
    ("google", ["www.google%"]),
    ("pinterest", ["www.pinterest%", "__.pinterest%", "pinterest"]),
    ("facebook", ["www.facebook%", "_.facebook%", "__.facebook%", "___.facebook%"]),
    ("images.google", ["images.google%"]),
    ("instagram", ["_.instagram%"]),
    ("yahoo", ["r.search.yahoo%"]),
]
# Subchannels per channel. What is not listed is 'unknown'.
CHANNEL_GROUPS = {
    "brand": ["direct", "paid brand google", "paid brand bing", "organic brand"],
    "paid search": ["paid search", "paid search bing", "paid search google"],
    "native": ["taboola", "yahoo", "ligatus"],
    "social paid": ["social paid fcbk"],
    "social organic": ["social organic fcbk"],
    "crm": [
        "transactional partner email",
        "transactional customer email",
        "marketing email",
        "email",
        "sms",
    ],
    "display remarketing": ["display retargeting sociomantic", "display remarketing google"],
    "display acquisition": ["display acquisition sociomantic", "display acquisition google"],
    "organic search": ["organic search"],
    "inbound call": ["inbound"],
    "referrer": ["referrer"],
}
# Product words and the product they mean.
PRODUCT_SYNONYMS = {
    "painter": "painting",
    "panting": "painting",
    "tiles": "tiling",
    "drywalling": "dry_walling",
    "laminat": "laminate",
    "floor": "flooring",
    "floori": "flooring",
    "parkett": "parquet",
    "fliesen": "tiling",
}
# Lead sources that sell leads.
LEAD_PROVIDERS = [
    "skydreams",
    "stucadooradviseur",
    "vakmanvinden",
    "watkostdeschilder",
    "watkosteenstucadoor",
    "watkosteenvloer",
    "daa",
    "maler4me",
]


def counts_as_referral(host: Column, referrer: Column) -> Column:
    """False for referrers on the exclusion list; unknown referrers count."""
    excluded = [host.like(p) for p in EXCLUDED_HOSTS] + [
        referrer.like(p) for p in EXCLUDED_REFERRERS
    ]
    return ~F.coalesce(any_of([F.coalesce(e, F.lit(False)) for e in excluded]), F.lit(False))


def referrer_name(host: Column) -> Column:
    named = [(name, any_of([host.like(p) for p in ps])) for name, ps in HOST_NAMES]
    return ladder(named, F.replace(host, F.lit("www."), F.lit("")))


def tagging_system(campaign: Column, is_lead_provider: Column) -> Column:
    countries = ["de", "be", "nl"]
    return ladder(
        [
            ("lead-provider", is_lead_provider),
            ("utm-builder", part(campaign, 2).isin(countries)),
            ("old-system", part(campaign, 1).isin(countries)),
        ],
        "other",
    )


def campaign_parts(house_brand: str = HOUSE_BRAND) -> dict[str, Column]:
    """Columns decoded from campaign, term and tagging system.

    Reads: campaign, term, medium, tagging_system, position_2, sn_camp, city_style, is_home_landing,
    refr_medium, is_lead_provider.
    """
    c = F.col
    campaign, term, system = c("campaign"), c("term"), c("tagging_system")
    built, old = system == "utm-builder", system == "old-system"

    def if_built(value: Column) -> Column:
        return F.when(built, value).otherwise("na")

    def blank_to_na(value: Column) -> Column:
        return F.coalesce(F.nullif(value, F.lit("")), F.lit("na"))

    return {
        "prefix": ladder(
            [("na", c("is_lead_provider")), (part(campaign, 2), old)], part(campaign, 1)
        ),
        "locale": ladder(
            [
                ("na", c("is_lead_provider")),
                (part(campaign, 2), built),
                (part(campaign, 1), old),
            ],
            "na",
        ),
        "campaign_type": if_built(part(campaign, 4)),
        "product_raw": ladder(
            [
                (
                    "brand",
                    (part(campaign, 1) == "b")
                    | (c("position_2") == "gsc")
                    | (part(campaign, 3) == house_brand),
                ),
                (part(campaign, 4), c("position_2") == "gdn"),
                (part(campaign, 3), built | (c("position_2") == "sn")),
                ("brand", c("is_home_landing") & (c("refr_medium") == "search")),
                (part(campaign, 3), system.isNull()),
            ],
            "na",
        ),
        "push": ladder(
            [
                ("na", c("is_lead_provider")),
                (part(c("sn_camp"), 4), c("position_2") == "sn"),
                (part(part(campaign, 4), 1, "-"), built),
            ],
            None,
        ),
        "city": F.when(c("is_lead_provider"), "na").otherwise(city_of(campaign, c("city_style"))),
        "extended_city": blank_to_na(
            ladder(
                [
                    ("na", c("is_lead_provider") | (c("medium") == "crm")),
                    (
                        part(campaign, 5),
                        (part(campaign, 1) == "gaw") & (part(campaign, 5) != "search"),
                    ),
                    (
                        F.coalesce(
                            F.nullif(part(term, 4), F.lit("")),
                            F.nullif(part(c("sn_camp"), 6), F.lit("")),
                            F.lit("na"),
                        ),
                        c("city_style") == "extended",
                    ),
                    (part(term, 4), built),
                ],
                None,
            )
        ),
        "audience": if_built(part(campaign, 5)),
        "sub_audience": if_built(part(term, 1)),
        "sub_campaign": if_built(part(term, 2)),
        "campaign_date": if_built(part(term, 3)),
        "crm_data": F.when(
            part(campaign, 2) == "crm",
            F.concat(part(campaign, 3), F.lit("_"), part(campaign, 4)),
        ),
    }


def subchannel() -> Column:
    """The channel ladder for visits; the first rule that holds wins."""
    c = F.col
    source, medium, prefix = c("source"), c("medium"), c("prefix")
    audience, kind, campaign = c("audience"), c("campaign_type"), c("campaign")
    searched, home = c("refr_medium") == "search", c("is_home_landing")

    mail = (source == "email") | (c("refr_medium") == "email") | (prefix == "crm")
    google_display = ((prefix == "dis") | (medium == "dis")) & source.isin(
        "google", "display network"
    )
    sociomantic = (source == "smt") | (prefix == "smt")
    paid_brand = (c("product_raw") == "brand") & (medium == "cpc")

    def either(pattern: str) -> Column:
        return audience.like(pattern) | kind.like(pattern)

    return ladder(
        [
            (
                "transactional partner email",
                mail & (medium == "transactional") & (audience == "partner"),
            ),
            ("transactional customer email", mail & (medium == "transactional")),
            (
                "marketing email",
                (mail & (medium == "marketing"))
                | medium.isin("email", "crm")
                | campaign.like("%crm_%"),
            ),
            ("email", source == "email"),
            ("display remarketing google", google_display & either("remarketing")),
            ("display acquisition google", google_display & either("acq%")),
            ("display smart google", google_display & audience.like("smart%")),
            ("paid brand google", paid_brand & (source == "google")),
            ("paid brand bing", paid_brand & (source == "bing")),
            (
                "paid search google",
                prefix.isin("gaw", "sn", "gsc", "gmb")
                | ((medium == "cpc") & (source == "google")),
            ),
            ("paid search bing", (prefix == "ba") | ((medium == "cpc") & (source == "bing"))),
            ("yahoo", source.isin("yahoo", "de.yahoo.com") | (prefix == "yh")),
            ("taboola", source.isin("taboola", "trc.taboola.com") | (prefix == "tb")),
            ("ligatus", (source == "ligatus") | (prefix == "lig")),
            (
                "display acquisition sociomantic",
                sociomantic & (either("acquisition") | (audience == "acqusition")),
            ),
            ("display retargeting sociomantic", sociomantic & either("retarget%")),
            (
                "social paid fcbk",
                prefix.isin("fb", "sp") | medium.isin("sp", "cpm"),
            ),
            (
                "social organic fcbk",
                (medium == "so") | (prefix == "so") | (c("refr_medium") == "social"),
            ),
            ("organic brand", home & searched),
            ("uncaught search", searched & (campaign != "")),
            ("organic search", searched),
            ("sms", source == "sms"),
            ("direct", home),
            ("uncaught utms", F.coalesce(medium, campaign, F.lit("")) != ""),
        ],
        "referrer",
    )


def channel_of(subchannel_column: Column) -> Column:
    return rolled_up(subchannel_column, CHANNEL_GROUPS, "unknown")


def legacy_channel() -> Column:
    c = F.col
    source, medium = c("source"), c("medium")
    searched = c("refr_medium") == "search"
    return ladder(
        [
            ("brand", c("product_raw") == "brand"),
            ("brand", c("is_home_landing") & searched),
            (
                "adwords",
                c("prefix").isin("gaw", "sn") | ((medium == "cpc") & (source == "google")),
            ),
            ("search", searched),
            (
                "display",
                (medium == "dis")
                | source.isin("taboola", "trc.taboola.com", "ligatus", "display network"),
            ),
            (
                "retargeting",
                (medium == "ret") | (part(c("campaign"), 5) == "retargeting") | (source == "smt"),
            ),
            ("social paid", medium == "sp"),
            ("social organic", (medium == "so") | (c("refr_medium") == "social")),
            ("email", (source == "mail") | (c("refr_medium") == "email")),
        ],
        "referrer",
    )


def product_of(product_raw: Column) -> Column:
    return mapped(product_raw, PRODUCT_SYNONYMS, product_raw)
