"""The jobs' input tables, derived row by row from the driver tables.

Each shape is one SELECT in the SQL that Spark and other engines share, so that the same text feeds
the Spark job and the SQL it is checked against. `{name}` stands for a driver table or another shape.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..rules.measures import MEASURES
from ..session import prepare

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Campaign codes that reach every branch of the channel, city and campaign rules.
CAMPAIGNS = [
    "gaw_de_painting_city-berlin_search",
    "gaw_de_painting_city-extended-hamburg_x",
    "gaw_nl_floor_generic_search",
    "gaw_de_parkett_münchen_extended",
    "gaw_de_partner_koln_brand",
    "gaw_tiles_generic",
    "dis_de_laminat_remarketing_all",
    "dis_de_painter_push_acquisition",
    "dis_de_painter_push_smartlist",
    "x_sn_drywalling_city-hamburg_essen_a$b",
    "crm_de_news_july_partner",
    "x_crm_news_july",
    "de_gaw_fliesen_x_y",
    "nl_so_panting_x_y",
    "gsc_de_roof_x_y",
    "x_gsc_roof_x",
    "b_de_roof_x_y",
    "x_gdn_roof_floori_x",
    "smt_de_roof_x_acquisition",
    "smt_de_roof_retargeting_x",
    "tb_de_roof_x_y",
    "lig_de_roof_x_y",
    "yh_de_roof_x_y",
    "ba_de_roof_x_y",
    "fb_de_roof_x_y",
    "sp_de_roof_x_y",
    "so_be_roof_x_y",
    "gmb_de_roof_x_y",
    "sn_de_roof_city_x",
    "summer",
]


def _pick(number: str, values: list[str | None]) -> str:
    """SQL choosing from a list by number modulo its length; the list folds to one literal."""
    joined = "|".join("~" if v is None else v for v in values)
    chosen = f"split_part('{joined}', '|', CAST(({number}) % {len(values)} AS INT) + 1)"
    return f"NULLIF({chosen}, '~')" if None in values else chosen


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

SHAPES: dict[str, str] = {}

# --- web tracking -------------------------------------------------------------------------------
# A copy of every 50th event arrives five seconds later, as trackers resend.
SHAPES["web_hits"] = f"""
SELECT event_id AS n, user_id AS u, {_K} AS k, CAST(ts AS TIMESTAMP) AS ts, event_type, value, props
FROM {{events}}
UNION ALL
SELECT event_id AS n, user_id AS u, {_K} AS k, CAST(ts AS TIMESTAMP) + INTERVAL '5' SECOND AS ts,
  event_type, value, props
FROM {{events}} WHERE event_id % 50 = 0
"""

_HOSTS = [
    "www.google.de", "www.facebook.com", "m.facebook.com", "images.google.de", "l.instagram.com",
    "r.search.yahoo.com", "www.pinterest.com", "de.pinterest.com", "eu6.salesforce.com",
    "c.eu6.visual.force.com", "www.example.org", "trc.taboola.com", None,
]
_PATHS = ["/", "/angebot", "/v2.2/dialog/oauth/x", "/login.php", "/p/q"]

SHAPES["web_events"] = f"""
SELECT
  CAST(n AS STRING) AS event_id,
  md5(CAST(n AS STRING)) AS event_fingerprint,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'purchase' THEN 'tr'
    WHEN 'signup' THEN 'transaction' ELSE event_type END AS event,
  CASE n % 19 WHEN 0 THEN 'web-internal' WHEN 1 THEN 'web-staging' WHEN 2 THEN NULL
    ELSE 'web' END AS app_id,
  ts AS collector_tstamp,
  ts AS derived_tstamp,
  CASE WHEN n % 211 = 0 THEN NULL ELSE CAST(u AS STRING) END AS domain_userid,
  CAST(u AS STRING) || '-' || CAST(CAST(floor(
    (extract(month FROM ts) * 744 + extract(day FROM ts) * 24 + extract(hour FROM ts)) / 30
  ) AS INT) AS STRING) AS domain_sessionid,
  CASE WHEN event_type = 'purchase' THEN CAST(n AS STRING) END AS tr_orderid,
  CASE n % 23 WHEN 0 THEN 'bot' WHEN 1 THEN NULL ELSE 'webkit' END AS br_renderengine,
  CASE WHEN k % 20 = 7 THEN 'email'
    ELSE {_pick("k", ["internal", "search", "social", None])} END AS refr_medium,
  {_pick("k + n", _HOSTS)} AS refr_urlhost,
  'https://' || {_pick("k + n", _HOSTS)} || {_pick("k", _PATHS)} AS page_referrer,
  'www.shop.example.com' AS page_urlhost,
  CASE WHEN k % 5 = 0 THEN '/' ELSE '/p' || CAST(k % 12 AS STRING) END AS page_urlpath,
  'Page ' || CAST(k % 12 AS STRING) AS page_title,
  'https://www.shop.example.com' || CASE WHEN k % 5 = 0 THEN '/' ELSE '/p' || CAST(k % 12 AS STRING) END
    || CASE WHEN n % 3 = 0 THEN '?utm_source=first&utm_medium=&utm_source=s' || CAST(k % 7 AS STRING)
      || '&utm_campaign=a%20b+c' || CAST(k % 4 AS STRING) || '&gclid=g' || CAST(n AS STRING)
      ELSE '' END
    || CASE WHEN n % 4 = 0 THEN '#top' ELSE '' END AS page_url,
  {_pick("k + n", ["google", "Bing", "yahoo", "taboola", "ligatus", "smt", "email", "sms", None,
                   "display network", "facebook"])} AS mkt_source,
  {_pick("n", ["cpc", "dis", "marketing", "transactional", "sp", "so", "crm", "email", "Organic",
               None, "", "cpm", "ret"])} AS mkt_medium,
  CASE WHEN k = 31 THEN repeat('long_', 60) WHEN k % 10 = 3 THEN NULL WHEN k % 10 = 4 THEN ''
    ELSE {_pick("k + 3 * n", CAMPAIGNS)} END AS mkt_campaign,
  {_pick("k", ["exact_g1_2017_koln", "broad_g2", None, "phrase_g3_x_", ""])} AS mkt_term,
  {_pick("n", ["a_b_c_k%C3%BCche%2Bbad_e", "a_b_c_100%_x", None, "x"])} AS mkt_content,
  CASE WHEN n % 6 = 0 THEN 'gcl-' || CAST(n AS STRING) END AS mkt_clickid,
  {_pick("u", ["Germany", "NETHERLANDS", "Austria", "belgium", "Atlantis", None])} AS geo_country,
  CASE WHEN u % 9 = 0 THEN NULL ELSE ' City' || CAST(u % 13 AS STRING) END AS geo_city,
  {_pick("u", ["desktop", "phone", "tablet"])} AS dvce_type,
  'z' || CAST(u % 50 AS STRING) AS geo_zipcode,
  CAST(u % 90 AS DOUBLE) / 8 AS geo_latitude,
  CAST(u % 170 AS DOUBLE) / -4 AS geo_longitude,
  {_pick("u", ["Hessen", None, "Utrecht"])} AS geo_region_name,
  'agent/' || CAST(k % 9 AS STRING) AS useragent,
  {_pick("u", ["Firefox 50", "Chrome 60", None])} AS br_name,
  {_pick("u", ["Firefox", "Chrome", None])} AS br_family,
  {_pick("u + k", ["50.0", "60.1", "9"])} AS br_version,
  {_pick("k", ["Browser", "Browser (mobile)"])} AS br_type,
  {_pick("u", ["de", "nl-NL", None, "en"])} AS br_lang,
  k % 2 = 0 AS br_features_pdf,
  CASE WHEN k % 7 = 0 THEN NULL ELSE 800 + k END AS br_viewwidth,
  600 + k AS br_viewheight,
  {_pick("u", ["Windows 10", "iOS 9", "Android 6"])} AS os_name,
  {_pick("u", ["Windows", "iOS", "Android"])} AS os_family,
  u % 3 > 0 AS dvce_ismobile,
  1000 + k AS dvce_screenwidth,
  700 + k AS dvce_screenheight,
  value,
  props
FROM {{web_hits}}
"""

SHAPES["load_log"] = """
SELECT max(CAST(ts AS TIMESTAMP)) AS logged_at, 'events_start' AS job_title, 'events' AS runner_title,
  0 AS position_type
FROM {events}
"""

SHAPES["tv_peaks"] = """
SELECT DISTINCT date_trunc('minute', CAST(ts AS TIMESTAMP)) AS minute,
  md5('tv-' || CAST(extract(hour FROM ts) AS STRING)) AS utm_id
FROM {events} WHERE event_type = 'signup'
"""

# Some users have logged in; one of them twice, under two names.
SHAPES["user_map"] = """
SELECT CAST(user_id AS STRING) AS domain_userid, 'login' || CAST(user_id * 7 AS STRING) AS login_user_id,
  'onsite' || CAST(user_id AS STRING) AS onsite_user_id
FROM {events} WHERE user_id % 3 > 0 GROUP BY user_id
UNION ALL
SELECT CAST(min(user_id) AS STRING), 'a second login', 'a second one' FROM {events} WHERE user_id % 3 > 0
"""

SHAPES["utm_ids"] = """
SELECT md5('') AS utm_id, CAST(2 AS BIGINT) AS id
UNION ALL SELECT md5('timeout'), CAST(3 AS BIGINT)
UNION ALL SELECT DISTINCT utm_id, CAST(100 AS BIGINT) + extract(hour FROM minute) FROM {tv_peaks}
"""

SHAPES["iso_country_codes"] = """
SELECT * FROM (VALUES ('germany', 'DE'), ('Netherlands', 'NL'), ('AUSTRIA', 'AT'), ('Belgium', 'BE'))
  AS t(country, iso_code)
"""

# --- ads ----------------------------------------------------------------------------------------
SHAPES["click_report"] = f"""
SELECT
  'gcl-' || CAST(event_id AS STRING) AS gcl_id,
  'Ac' || CAST(event_id % 3 AS STRING) AS account_id,
  'c' || CAST(event_id % 7 AS STRING) AS campaign_id,
  {_pick("event_id % 30", [c.upper() for c in CAMPAIGNS])} AS campaign_name,
  'g' || CAST(event_id % 48 AS STRING) AS ad_group_id,
  'Group ' || CAST(event_id % 48 AS STRING) AS ad_group_name,
  {_pick("event_id", ["Search Network", "Display Network", "Search Network", "YouTube", "Content"])}
    AS ad_network_type1,
  CASE WHEN event_id % 12 = 0 THEN 'Exact' END AS keyword_match_type,
  CAST(CAST(ts AS TIMESTAMP) + CASE WHEN event_id % 30 = 0 THEN INTERVAL '1' HOUR
    WHEN event_id % 42 = 0 THEN INTERVAL '72' HOUR ELSE INTERVAL '0' HOUR END AS DATE) AS date
FROM {{events}} WHERE event_id % 6 = 0
"""

SHAPES["adgroup_report"] = f"""
SELECT
  'Ac' || CAST(l_suppkey % 3 AS STRING) AS account_id,
  {_pick("l_suppkey", ["DE main", "Germany two", "NL main", "netherlands", "UK"])} AS account_name,
  'c' || CAST(l_partkey % 7 AS STRING) AS campaign_id,
  {_pick("l_partkey", [c.upper() for c in CAMPAIGNS])} AS campaign_name,
  'g' || CAST(l_partkey % 48 AS STRING) AS ad_group_id,
  'Group_' || CAST(l_partkey % 48 AS STRING) AS ad_group_name,
  {_pick("l_partkey", ["Search Network", "Display Network", "YouTube"])} AS ad_network_type1,
  CAST(l_shipdate AS DATE) AS date,
  CAST(l_quantity AS INT) * 10 AS impressions,
  CAST(l_quantity AS INT) AS clicks,
  l_extendedprice AS cost
FROM {{lineitem}} WHERE l_returnflag <> 'R'
"""

SHAPES["adset_report"] = f"""
SELECT
  'FB' || CAST(l_suppkey % 2 AS STRING) AS account_id,
  {_pick("l_suppkey", ["HouseBrand_DE", "HouseBrand_NL", "Other"])} AS account_name,
  'f' || CAST(l_partkey % 5 AS STRING) AS campaign_id,
  {_pick("l_partkey + 11", CAMPAIGNS)} AS campaign_name,
  'a' || CAST(l_partkey % 9 AS STRING) AS adset_id,
  'Set_' || CAST(l_partkey % 9 AS STRING) AS adset_name,
  CAST(l_shipdate AS DATE) AS date,
  CAST(l_quantity AS INT) * 7 AS impressions,
  CAST(l_quantity AS INT) AS clicks,
  CAST(l_quantity AS INT) * 3 AS reach,
  l_extendedprice AS spend
FROM {{lineitem}} WHERE l_returnflag = 'R'
"""

SHAPES["sheet_spend"] = f"""
SELECT
  CAST(o_orderdate AS DATE) AS date,
  o_totalprice * 30 AS month_spend,
  o_totalprice AS spend,
  {_pick("o_custkey", ["paid search", "native", "retargeting", "radio"])} AS marketing_channel,
  {_pick("o_orderkey", ["yahoo", "taboola", "ligatus", "bing", "smt", "flyer"])} AS source
FROM {{orders}}
"""

# --- leads --------------------------------------------------------------------------------------
_STATUS = ["Qualified", "Unqualified", "Dublicate", "Untouched", "not contacted", "Not interested",
           "1st Call", "2nd Call done", "Open"]
SHAPES["crm_leads"] = f"""
SELECT
  'L' || CAST(event_id AS STRING) AS id,
  CAST(event_id AS STRING) AS backend_opportunity_id,
  'owner' || CAST(event_id % 5 AS STRING) AS owner_id,
  {_pick("event_id", ["HouseBrand", "housebrand - intern", "Referral (intern)", "Inbound Call", "daa",
                      "maler4me", None, "skydreams", "facebook"])} AS source,
  {_pick("event_id", ["n/a", "", None, "Spring", "x_campaign"])} AS lead_campaign,
  {_pick("user_id", ["Google", None, "taboola", "smt", "", "bing"])} AS mkt_source,
  {_pick("user_id", ["cpc", None, "Transactional", ""])} AS mkt_medium,
  {_pick("user_id + event_id", [*CAMPAIGNS, None, ""])} AS mkt_campaign,
  {_pick("event_id", _STATUS)} AS status,
  {_pick("event_id", ["Duplicate", "Fake request", "Wrong data: phone", "Expired in lead queue", None,
                      "ok", "ok2"])} AS substatus,
  {_pick("event_id", ["Mr.", "Mrs.", None])} AS salutation,
  {_pick("user_id", ["Deutschland", "Nederland", "Austria", None])} AS country,
  {_pick("user_id", ["Berlin ", "Utrecht", None, "Wien"])} AS city,
  {_pick("event_id", ["de", "nl", None])} AS job_country,
  {_pick("event_id", ["Hamburg", None, " Essen"])} AS job_city,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE ' 10-' || CAST(event_id % 977 AS STRING) END AS postal_code,
  '99 ' || CAST(event_id % 97 AS STRING) AS job_postal_code,
  {_pick("event_id", ["record-partner-lead", "record-lead", "record-customer", "other"])}
    AS record_type_id,
  {_pick("event_id", ["painting", "Tiling", "flooring", "wall_tiling", None, "varnish"])} AS main_vertical,
  CAST(ts AS TIMESTAMP) AS created_date,
  CAST(ts AS TIMESTAMP) + INTERVAL '36' HOUR AS last_modified_date,
  CASE WHEN event_id % 2 = 0 THEN CAST(ts AS TIMESTAMP) + INTERVAL '50' HOUR END AS lead_process_end,
  CAST(ts AS TIMESTAMP) + INTERVAL '2' HOUR AS call_1_timestamp,
  value AS score,
  value * 2 AS price,
  event_id % 37 = 0 AS is_trainings_lead
FROM {{events}} WHERE event_type = 'purchase'
"""

SHAPES["opportunity_offers"] = """
SELECT
  'L' || CAST(event_id - event_id % 3 AS STRING) AS sf_lead_id,
  'O' || CAST(event_id AS STRING) AS sf_opportunity_id,
  'F' || CAST(event_id AS STRING) AS sf_offer_id,
  CAST(event_id AS BIGINT) AS hb_lead_id,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) + INTERVAL '30' HOUR END AS qualified_at
FROM {events} WHERE event_type = 'purchase' AND event_id % 2 = 0
"""

SHAPES["crm_opportunities"] = f"""
SELECT
  'O' || CAST(event_id AS STRING) AS id,
  'L' || CAST(event_id - event_id % 3 AS STRING) AS legacy_lead_id,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE 'agent' || CAST(event_id % 11 AS STRING) END AS sales_agent_lookup,
  {_pick("event_id", ["Fake booking by customer", None, "No partner found"])} AS opscancellationreason,
  {_pick("event_id", ["DE", "NL ", None, "us"])} AS job_country,
  {_pick("event_id", ["Köln", " Bonn", None])} AS job_city,
  CAST(ts AS TIMESTAMP) + INTERVAL '31' HOUR AS created_date,
  CAST(ts AS TIMESTAMP) + INTERVAL '60' HOUR AS last_modified_date
FROM {{events}} WHERE event_type = 'purchase' AND event_id % 2 = 0
"""

SHAPES["agent_touches"] = "UNION ALL".join(
    f"""
SELECT
  event_id + {step} AS lead_id,
  CASE WHEN (event_id + {step}) % 13 = 0 THEN 'lead-queue'
    ELSE 'agent' || CAST((event_id + user_id) % 11 AS STRING) END AS agent_id,
  CAST(ts AS TIMESTAMP) AS lead_touchpoint_at
FROM {{events}} WHERE event_type IN ('click', 'purchase')
"""
    for step in range(3)
)

SHAPES["country_mapping"] = """
SELECT * FROM (VALUES ('Deutschland', 'de'), ('Nederland', 'nl'), ('Belgie', 'be'))
  AS t(leads_country, opportunities_country)
"""

SHAPES["valid_leads"] = """
SELECT event_id AS lead_id FROM {events} WHERE event_type = 'purchase' AND event_id % 2 = 0
"""

# The measures rise with their position in the list; every lead has them all.
SHAPES["lead_measures"] = f"""
SELECT
  event_id AS lead_id,
  CAST(ts AS TIMESTAMP) AS lead_created_at,
  value * 0.5 AS lead_price,
  CAST(event_id % 5 AS BIGINT) AS primary_vertical_type_id,
  md5('lead-' || CAST(event_id % 7 AS STRING)) AS utm_id,
  CASE WHEN event_id % 3 = 0 THEN 'deberlin' END AS geo_id,
  {", ".join(f"value * {i + 1} AS {m}" for i, m in enumerate(MEASURES))}
FROM {{events}} WHERE event_type = 'purchase'
"""

# --- sales --------------------------------------------------------------------------------------
SHAPES["verticals"] = """
SELECT CAST(min(p_partkey) % 1000 AS INT) + 100 AS id, lower(p_type) AS name,
  CAST(min(p_size) % 3 AS INT) AS area_type_id
FROM {part} GROUP BY lower(p_type)
"""

SHAPES["sales_revenue"] = """
SELECT
  CAST(l_orderkey AS STRING) AS opportunity_id,
  CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS offer_id,
  CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE 'agent' || CAST(l_suppkey % 11 AS STRING) END AS sales_agent_id,
  lower(p_type) AS main_vertical,
  lower(p_type) AS vertical,
  CAST(CAST(l_shipdate AS TIMESTAMP) + INTERVAL '20' YEAR AS DATE) AS offer_closed_date,
  CAST(CAST(l_shipdate AS TIMESTAMP) + INTERVAL '20' YEAR AS DATE) AS offer_prepared_date,
  l_extendedprice * l_discount AS final_margin,
  l_extendedprice * (1 - l_discount) AS nmv,
  CASE WHEN l_linenumber = 7 THEN 0.04 ELSE l_quantity / 50 END AS opportunity_part_ratio,
  l_linenumber > 5 AS bin_upsell,
  CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice * l_tax ELSE 0 END AS epd_net
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

# Sales are moved on by 20 years, so that the fixed first day of the study cuts through them.
_ORDER_DAY = "CAST(o_orderdate AS TIMESTAMP) + INTERVAL '20' YEAR"
SHAPES["opportunities"] = f"""
SELECT
  CAST(o_orderkey AS STRING) AS opportunity_id,
  CAST(o_custkey % 97 AS STRING) AS partner_id,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'P' || CAST(o_custkey % 97 AS STRING) END AS sf_partner_id,
  'agent' || CAST(o_custkey % 11 AS STRING) AS ops_agent_id,
  {_pick("o_custkey", ["de", "nl", "de", "us"])} || CAST(o_custkey % 31 AS STRING) AS zip_id,
  {_pick("o_orderkey", ["No partner found", "Problems caused by partner", None, "other"])}
    AS cancellation_reason,
  CAST({_ORDER_DAY} + INTERVAL '960' HOUR AS DATE) AS wish_start_date,
  CASE WHEN o_orderkey % 5 <> 0 OR o_orderkey % 35 = 0 THEN
    CAST({_ORDER_DAY} + INTERVAL '240' HOUR AS DATE) END AS job_prepared_date,
  CASE WHEN o_orderstatus = 'O' THEN CAST({_ORDER_DAY} + CASE o_custkey % 3
    WHEN 0 THEN INTERVAL '1200' HOUR WHEN 1 THEN INTERVAL '1440' HOUR ELSE INTERVAL '300' HOUR END AS DATE)
    END AS cancellation_date,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST({_ORDER_DAY} + INTERVAL '720' HOUR AS DATE) END
    AS first_rematched_date,
  CASE WHEN o_orderstatus = 'F' OR o_orderkey % 41 = 0 THEN
    CAST({_ORDER_DAY} + INTERVAL '2400' HOUR AS DATE) END AS job_completed_date,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST({_ORDER_DAY} + CASE WHEN o_custkey % 5 = 0 THEN
    INTERVAL '312' HOUR ELSE INTERVAL '240' HOUR END AS DATE) END AS downpayment_invoice_date,
  o_totalprice AS invoiced_amount,
  o_orderkey % 43 <> 0 AS bin_valid_opportunity,
  o_orderkey % 6 = 0 AS bin_upsold,
  o_orderkey % 5 <> 0 AS bin_prepared,
  o_orderkey % 9 = 0 AS bin_rematched,
  o_orderstatus = 'F' AS bin_completed,
  o_orderstatus = 'O' AS bin_cancelled,
  o_orderkey % 12 <> 7 AS bin_won_opp,
  o_orderstatus = 'F' AND o_orderkey % 3 <> 0 AS bin_invoiced,
  o_orderkey % 2 = 0 AS is_image_uploaded
FROM {{orders}}
"""

SHAPES["invoices"] = """
SELECT
  CAST(l_orderkey AS STRING) AS opportunity_id,
  l_extendedprice * 0.9017 AS net_invoiced_amount,
  l_extendedprice * 0.5 AS partner_costs,
  l_extendedprice * l_tax AS additional_costs,
  CASE WHEN l_linenumber = 2 THEN l_discount * 100 ELSE 0 END AS csd,
  CASE WHEN l_linenumber = 3 THEN l_discount * 10 ELSE 0 END AS epd
FROM {lineitem} WHERE l_linestatus = 'F'
"""

SHAPES["partners"] = f"""
SELECT CAST(o_custkey % 97 AS STRING) AS partner_id, 'P' || CAST(o_custkey % 101 AS STRING) AS sf_partner_id,
  max({_pick("o_custkey % 97", ["active", "dropout", "black_sheep", "active", "disabled_partner"])}) AS status
FROM {{orders}} GROUP BY o_custkey % 97, o_custkey % 101
"""

SHAPES["agents"] = """
SELECT DISTINCT 'agent' || CAST(l_suppkey % 11 AS STRING) AS agent_id,
  'Agent ' || CAST(l_suppkey % 11 AS STRING) AS name, l_suppkey % 11 < 8 AS bin_active
FROM {lineitem}
"""

SHAPES["zip_codes"] = f"""
SELECT DISTINCT
  {_pick("c_custkey", ["de", "nl", "de", "us"])} || CAST(c_custkey % 31 AS STRING) AS zip_id,
  CASE WHEN c_custkey % 31 = 30 THEN NULL ELSE 'city' || CAST(c_custkey % 31 % 12 AS STRING) END AS city_bucket,
  'state' || CAST(c_custkey % 31 % 5 AS STRING) AS federal_state,
  CASE WHEN c_custkey % 31 % 7 = 0 THEN NULL
    ELSE {_pick("c_custkey", ["de", "nl", "de", "us"])} END AS country,
  c_custkey % 31 % 2 = 0 AS is_urban,
  CASE WHEN c_custkey % 31 = 29 THEN NULL ELSE CAST(c_custkey % 31 % 4 AS STRING) END
    AS population_bucket_radius
FROM {{customer}}
"""

SHAPES["raw_stamps"] = f"""
SELECT event_id, {_pick("event_id", ["2018-03-04", "1522800000123", "1522800000",
  "2018-03-04T05:06:07Z", "2018-03-04 05:06:07.5", "04/05/2018", "20180304", "nonsense"])} AS raw_value,
  props
FROM {{events}}
"""


@cache
def parts_of(name: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(re.findall(r"\{(\w+)\}", SHAPES[name])))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a shape as a DataFrame."""
    if name in DRIVER_TABLES:
        return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {part: table(spark, sf_dir, part) for part in parts_of(name)}
    return spark.sql(SHAPES[name], **inputs)


def with_clause(*names: str) -> str:
    """The shapes and all they need as the head of a SQL statement, for the checking SQL."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name in DRIVER_TABLES or name in ordered:
            return
        for part in parts_of(name):
            add(part)
        ordered[name] = re.sub(r"\{(\w+)\}", r"\1", SHAPES[name]).strip()

    for name in names:
        add(name)
    return ",\n".join(f"{name} AS (\n{text}\n)" for name, text in ordered.items())
