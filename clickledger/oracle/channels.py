"""Channels, ad groups and spend. Rules are tables of label and condition in order of rank."""

CHECKS = {}

HOUSE_BRAND = "housebrand"
# fixed values: words by which campaigns name a city, in the order in which they are looked for
CITY_WORDS = ['nrw', 'niedersachsen', 'nuremberg', 'cologne', 'freiburg', 'münchen', 'rostock', 'kiel',
 'münster', 'duisburg', 'magdeburg', 'karlsruhe', 'bremen', 'frankfurt', 'dresden', 'leipzig',
 'kassel', 'braunschweig', 'berlin', 'augburg', 'mainz', 'muesnter', 'city-extended', 'baden',
 'bayern', 'extended', 'muenster', 'duesseldorf', 'wiesbaden', 'munich', 'nurnberg', 'munchen',
 'bonn', 'munster', 'dusseldorf', 'köln', 'bielefeld', 'koln', 'hannover', 'mannheim', 'essen',
 'bochum', 'dortmund', 'augsburg', 'nürnberg', 'general', 'stuttgart', 'düsseldorf', 'hamburg']


def ranked(rules: list[tuple[str, str]], rest: str) -> str:
    """Label of the first rule that holds, else the rest: the lowest rank of a list of (label, holds)."""
    rows = ", ".join(f"{{'label': {label}, 'holds': coalesce({rule}, false)}}" for label, rule in rules)
    return f"coalesce(list_filter([{rows}], lambda r: r.holds)[1].label, {rest})"


def text(label: str) -> str:
    return f"'{label}'"


def table(rules: list[tuple[str, str]], rest: str) -> str:
    return ranked([(text(label), rule) for label, rule in rules], text(rest))


def among(column: str, *values: str) -> str:
    return f"list_contains(['{"', '".join(values)}'], {column})"


def begins(column: str, *starts: str) -> str:
    return "(" + " OR ".join(f"starts_with({column}, '{x}')" for x in starts) + ")"


def bit(column: str, n: int, by: str = "_") -> str:
    """The n-th part of a name, empty where there is none."""
    return f"ifnull(string_split({column}, '{by}')[{n}], '')"


_HITS = "list_filter([" + ", ".join(map(text, CITY_WORDS)) + "], lambda w: contains(campaign, w))"
CITY = f"ifnull({_HITS}[1], 'na')"
_ADS = begins("campaign", "gaw")
CITY_STYLE = table(
    [
        ("extended", f"{bit('campaign', 5)} = 'extended'"),
        ("extended", begins(bit("campaign", 4), "city-extended")),
        ("extended", f"{_ADS} AND contains(campaign, 'extended')"),
        ("city", f"{_ADS} AND (contains(campaign, 'city') OR len({_HITS}) > 0)"),
        ("non_city", _ADS),
    ],
    "na",
)


def to_int(word: str, depth: int) -> str:
    """Sum of character codes times powers of 36, over the first letters and digits."""
    kept = f"lower(regexp_replace({word}, '[^A-Za-z0-9]', '', 'g'))"
    terms = [
        f"coalesce(ascii(nullif(substr({kept}, {i + 1}, 1), '')), 0) * {36**i}" for i in range(depth)
    ]
    return f"CASE WHEN {word} IS NOT NULL THEN {' + '.join(terms)} END"


_UTC_AND_BERLIN = (
    "[collector_tstamp::DATE, timezone('Europe/Berlin', timezone('UTC', collector_tstamp))::DATE]"
)
# a click belongs to the events of its id on its day, in UTC or in Berlin
CHECKS["clicks_matched"] = f"""
SELECT gcl_id, ad_group_id, date, event_id, collector_tstamp
FROM {{click_report}} JOIN {{web_events}} ON gcl_id = mkt_clickid
WHERE list_contains({_UTC_AND_BERLIN}, date)
"""

# Each parameter of an ad group is what its latest click that has it says.
_SAID = {"source": "mkt_source", "medium": "mkt_medium", "campaign": "campaign_name",
         "term": "mkt_term", "content": "mkt_content"}
CHECKS["adgroups"] = f"""
WITH said AS (
  SELECT ad_group_id, concat_ws('', account_id, campaign_id, ad_group_id) AS join_id, account_id,
    campaign_id, date, (date, collector_tstamp, event_id) AS moment,
    {", ".join(f"lower({c}).trim() AS {n}" for n, c in _SAID.items())}
  FROM {{click_report}} JOIN {{web_events}} ON gcl_id = mkt_clickid
  WHERE date > DATE '2017-06-01' AND list_contains({_UTC_AND_BERLIN}, date)
    AND account_id IS NOT NULL AND campaign_id IS NOT NULL AND ad_group_id IS NOT NULL
), latest AS (
  SELECT ad_group_id, max(date) AS click_date,
    {", ".join(f"max_by({n}, moment) FILTER ({n} IS NOT NULL) AS {n}" for n in _SAID)}
  FROM said GROUP BY ad_group_id
), named AS (
  SELECT *, source || medium || campaign || term AS marketing_string_id, {bit("content", 4)} AS word
  FROM (SELECT DISTINCT join_id, account_id, campaign_id, ad_group_id FROM said) JOIN latest USING (ad_group_id)
)
SELECT marketing_string_id, rank() OVER (PARTITION BY marketing_string_id
    ORDER BY click_date DESC, join_id) AS marketing_string_rank,
  join_id, account_id, campaign_id, ad_group_id, source, medium, campaign, term, content, click_date,
  CASE WHEN content IS NOT NULL
    THEN url_decode(regexp_replace(replace(word, '+', '%2B'), '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)', '%25\\1', 'g'))
    END AS keyword
FROM named
"""

# fixed values: hosts of one's own tools, and pages that pay or log in
_OWN_HOSTS = ["eu6.sale", "c.eu6.vis", "c.cs84.vis", "eu6.ligh", "na39.sale", "na35.sale"]
_PASSED_PAGES = ["https://www.paypal", "hooks.stripe", "https://www.facebook.com/v2.2/dialog/oauth",
                 "https://www.facebook.com/login.php", "https://m.facebook.com/login.php",
                 "https://free.facebook.com/"]
REFERRER_KEPT = (
    f"NOT ifnull({begins('refr_urlhost', *_OWN_HOSTS)}, false) "
    f"AND NOT ifnull({begins('page_referrer', *_PASSED_PAGES)}, false)"
)
CHECKS["referred"] = f"""
SELECT event_id, refr_urlhost, page_referrer FROM {{web_events}} WHERE {REFERRER_KEPT}
"""

_HOST = ranked(
    [
        ("'google'", begins("refr_urlhost", "www.google")),
        ("'pinterest'", "regexp_matches(refr_urlhost, '^(www|..)[.]pinterest')"),
        ("'facebook'", "regexp_matches(refr_urlhost, '^.{1,3}[.]facebook')"),
        ("'images.google'", begins("refr_urlhost", "images.google")),
        ("'instagram'", "regexp_matches(refr_urlhost, '^.[.]instagram')"),
        ("'yahoo'", begins("refr_urlhost", "r.search.yahoo")),
    ],
    "replace(refr_urlhost, 'www.', '')",
)
_NETWORK = "CASE lower(ad_network_type1) WHEN 'search network' THEN 'google' ELSE lower(ad_network_type1) END"
CHECKS["prepared_channels"] = f"""
WITH visits AS (
  SELECT event_id, event_fingerprint, collector_tstamp, page_urlpath = '/' AS is_home_landing, refr_medium,
    mkt_source AS own_source, mkt_medium, mkt_campaign, mkt_term, mkt_content,
    lower(ifnull({_HOST}, '')) AS refr_host,
    mkt_source || mkt_medium || mkt_campaign || mkt_term AS marketing_string_id,
    struct_pack(id := mkt_clickid, day := collector_tstamp::DATE) AS click
  FROM {{web_events}} WHERE {REFERRER_KEPT}
), paid AS (
  SELECT struct_pack(id := gcl_id, day := date) AS click, ad_group_id IS NOT NULL AS is_paid,
    campaign_name, campaign_id AS paid_campaign, ad_group_id AS paid_group, ad_group_name,
    keyword_match_type, {_NETWORK} AS network
  FROM {{click_report}}
), known AS (
  SELECT marketing_string_id, campaign AS known_campaign, join_id, account_id, campaign_id AS campaign_key,
    ad_group_id AS group_key
  FROM {{adgroups}} WHERE marketing_string_rank = 1
), met AS (
  SELECT *, ifnull(is_paid, false) AS bought, CASE WHEN own_source IS NULL AND refr_medium = 'email' THEN 'email' END AS mailed
  FROM visits LEFT JOIN paid USING (click) LEFT JOIN known USING (marketing_string_id)
), named AS (
  SELECT event_id, event_fingerprint, collector_tstamp, is_home_landing, refr_medium, refr_host, join_id, account_id,
    ifnull(mailed, if(bought, network, lower(own_source))) AS mkt_source,
    if(bought, 'cpc', lower(ifnull(mkt_medium, ''))) AS medium,
    lower(coalesce(known_campaign, campaign_name, mkt_campaign, '')) AS campaign,
    lower(coalesce(ad_group_name, mkt_term, '')) AS term,
    lower(coalesce(keyword_match_type, string_split(mkt_term, '_')[1], '')) AS match_type,
    lower(ifnull(mkt_content, '')) AS content,
    ifnull(campaign_key, paid_campaign) AS campaign_id, ifnull(group_key, paid_group) AS ad_group_id,
    false AS is_lead_provider
  FROM met
)
SELECT *,
  md5(concat(mkt_source, refr_host, medium, campaign, term, content, if(is_home_landing, 't', 'f'))) AS utm_id,
  {table([("utm-builder", among(bit("campaign", 2), "de", "be", "nl")), ("old-system", among(bit("campaign", 1), "de", "be", "nl"))], "other")}
    AS tagging_system,
  {bit("campaign", 2)} AS position_2, {CITY_STYLE} AS city_style,
  CASE {bit("campaign", 2)} WHEN 'sn' THEN {bit("campaign", 1, "$")} END AS sn_camp,
  CASE WHEN {begins("campaign", "gaw_de_partner")} THEN {bit("term", 2)} END AS adgroup_id_from_utm,
  if(ifnull(mkt_source, '') = '', refr_host, mkt_source) AS source
FROM named
"""

# Where each campaign system keeps a value: (part of the campaign or term) by tagging system.
_NEW = "tagging_system = 'utm-builder'"
_FROM_NEW = {"campaign_type": "c[4]", "audience": "c[5]", "sub_audience": "t[1]", "sub_campaign": "t[2]",
             "campaign_date": "t[3]"}
PRODUCT_RAW = ranked(
    [
        ("'brand'", f"c[1] = 'b' OR position_2 = 'gsc' OR c[3] = '{HOUSE_BRAND}'"),
        ("ifnull(c[4], '')", "position_2 = 'gdn'"),
        ("ifnull(c[3], '')", f"{_NEW} OR position_2 = 'sn'"),
        ("'brand'", "is_home_landing AND refr_medium = 'search'"),
    ],
    "'na'",
)
_EXTENDED_CITY = ranked(
    [
        ("'na'", "medium = 'crm'"),
        ("ifnull(c[5], '')", "c[1] = 'gaw' AND ifnull(c[5], '') <> 'search'"),
        ("list_filter([t[4], s[6], 'na'], lambda x: x <> '')[1]", "city_style = 'extended'"),
        ("ifnull(t[4], '')", _NEW),
    ],
    "'na'",
)
CHECKS["decoded_channels"] = f"""
WITH latest AS (
  SELECT unnest(max_by(p, (collector_tstamp, event_id, event_fingerprint))) FROM {{prepared_channels}} p GROUP BY utm_id
), cut AS (
  SELECT *, string_split(campaign, '_') AS c, string_split(term, '_') AS t, string_split(sn_camp, '_') AS s,
    if(tagging_system = 'old-system', [2, 1], [1, 2]) AS places
  FROM latest
)
SELECT * EXCLUDE (c, t, s, places), ifnull(c[places[1]], '') AS prefix,
  if(tagging_system = 'other', 'na', ifnull(c[places[2]], '')) AS locale,
  {", ".join(f"if({_NEW}, ifnull({v}, ''), 'na') AS {n}" for n, v in _FROM_NEW.items())},
  {PRODUCT_RAW} AS product_raw,
  CASE WHEN position_2 = 'sn' THEN ifnull(s[4], '') WHEN {_NEW} THEN {bit("ifnull(c[4], '')", 1, "-")} END AS push,
  if({_ADS} AND city_style = 'city', {CITY}, 'na') AS city,
  if({_EXTENDED_CITY} = '', 'na', {_EXTENDED_CITY}) AS extended_city,
  CASE position_2 WHEN 'crm' THEN ifnull(c[3], '') || '_' || ifnull(c[4], '') END AS crm_data
FROM cut
"""

_MAIL = "(source = 'email' OR refr_medium = 'email' OR prefix = 'crm')"
_SHOWN = f"((prefix = 'dis' OR medium = 'dis') AND {among('source', 'google', 'display network')})"
_BRAND_AD = "(product_raw = 'brand' AND medium = 'cpc')"
_SMT = "(source = 'smt' OR prefix = 'smt')"
_FOUND = "refr_medium = 'search'"
# fixed values: labels and conditions, in order of rank
SUBCHANNEL = table(
    [
        ("transactional partner email", f"{_MAIL} AND medium = 'transactional' AND audience = 'partner'"),
        ("transactional customer email", f"{_MAIL} AND medium = 'transactional'"),
        ("marketing email", f"{_MAIL} AND medium = 'marketing'"),
        ("marketing email", among("medium", "email", "crm")),
        ("marketing email", "regexp_matches(campaign, 'crm.')"),
        ("email", "source = 'email'"),
        ("display remarketing google", f"{_SHOWN} AND 'remarketing' IN (audience, campaign_type)"),
        ("display acquisition google", f"{_SHOWN} AND ({begins('campaign_type', 'acq')} OR {begins('audience', 'acq')})"),
        ("display smart google", f"{_SHOWN} AND {begins('audience', 'smart')}"),
        ("paid brand google", f"{_BRAND_AD} AND source = 'google'"),
        ("paid brand bing", f"{_BRAND_AD} AND source = 'bing'"),
        ("paid search google", among("prefix", "gaw", "sn", "gsc", "gmb")),
        ("paid search google", "medium = 'cpc' AND source = 'google'"),
        ("paid search bing", "prefix = 'ba'"),
        ("paid search bing", "medium = 'cpc' AND source = 'bing'"),
        ("yahoo", "prefix = 'yh' OR " + among("source", "yahoo", "de.yahoo.com")),
        ("taboola", "prefix = 'tb' OR " + among("source", "taboola", "trc.taboola.com")),
        ("ligatus", "prefix = 'lig' OR source = 'ligatus'"),
        ("display acquisition sociomantic", f"{_SMT} AND (campaign_type = 'acquisition' OR {among('audience', 'acquisition', 'acqusition')})"),
        ("display retargeting sociomantic", f"{_SMT} AND ({begins('audience', 'retarget')} OR {begins('campaign_type', 'retarget')})"),
        ("social paid fcbk", among("prefix", "fb", "sp")),
        ("social paid fcbk", among("medium", "sp", "cpm")),
        ("social organic fcbk", "'so' IN (medium, prefix) OR refr_medium = 'social'"),
        ("organic brand", f"is_home_landing AND {_FOUND}"),
        ("uncaught search", f"{_FOUND} AND campaign <> ''"),
        ("organic search", _FOUND),
        ("sms", "source = 'sms'"),
        ("direct", "is_home_landing"),
        ("uncaught utms", "ifnull(ifnull(medium, campaign), '') <> ''"),
    ],
    "referrer",
)
# fixed values: the channel of each subchannel
_CHANNEL_OF = {
    "brand": ["direct", "paid brand google", "paid brand bing", "organic brand"],
    "paid search": ["paid search", "paid search bing", "paid search google"],
    "native": ["taboola", "yahoo", "ligatus"],
    "social paid": ["social paid fcbk"],
    "social organic": ["social organic fcbk"],
    "crm": ["transactional partner email", "transactional customer email", "marketing email", "email", "sms"],
    "display remarketing": ["display retargeting sociomantic", "display remarketing google"],
    "display acquisition": ["display acquisition sociomantic", "display acquisition google"],
    "organic search": ["organic search"],
    "inbound call": ["inbound"],
    "referrer": ["referrer"],
}
CHANNEL = table([(name, among("mkt_subchannel", *subs)) for name, subs in _CHANNEL_OF.items()], "unknown")
_OLD_CHANNEL = table(
    [
        ("brand", "product_raw = 'brand'"),
        ("brand", f"is_home_landing AND {_FOUND}"),
        ("adwords", among("prefix", "gaw", "sn")),
        ("adwords", "medium = 'cpc' AND source = 'google'"),
        ("search", _FOUND),
        ("display", "medium = 'dis' OR " + among("source", "taboola", "trc.taboola.com", "ligatus", "display network")),
        ("retargeting", f"medium = 'ret' OR {bit('campaign', 5)} = 'retargeting' OR source = 'smt'"),
        ("social paid", "medium = 'sp'"),
        ("social organic", "medium = 'so' OR refr_medium = 'social'"),
        ("email", "source = 'mail' OR refr_medium = 'email'"),
    ],
    "referrer",
)
# fixed values: products under one name
_PRODUCT = {"painter": "painting", "panting": "painting", "tiles": "tiling", "fliesen": "tiling",
            "drywalling": "dry_walling", "laminat": "laminate", "floor": "flooring", "floori": "flooring",
            "parkett": "parquet"}
_RENAMED = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in _PRODUCT.items()) + "}"
CHECKS["channel_rule_rows"] = f"""
SELECT *, {CHANNEL} AS mkt_channel FROM (
  SELECT *, {SUBCHANNEL} AS mkt_subchannel, {_OLD_CHANNEL} AS channel,
    ifnull(({_RENAMED})[product_raw], product_raw) AS product
  FROM {{decoded_channels}})
"""
CHECKS["classified_channels"] = f"""
SELECT utm_id, mkt_subchannel, mkt_channel, channel, 'web' AS mkt_medium, product,
  {to_int("product", 4)} AS vertical_type_id, left(medium, 32) AS medium,
  left(coalesce(source, 'other'), 128) AS source, left(source, 128) AS detailed_source,
  left(refr_host, 128) AS referrer, left(campaign, 128) AS campaign, left(term, 128) AS term,
  left(content, 500) AS content, refr_medium, is_lead_provider, 1 AS bin_internal, city_style, city,
  extended_city, prefix, push, audience, sub_audience, campaign_date, crm_data, join_id, account_id,
  left(campaign_id, 32) AS campaign_id, left(ad_group_id, 32) AS ad_group_id, match_type,
  collector_tstamp AS updated_at, CAST(NULL AS BIGINT) AS pbi_utm_id
FROM {{channel_rule_rows}}
"""


def _seed(key: str, name: str, fill: str, special: dict[str, str], internal: int, pbi: str) -> str:
    text = dict.fromkeys(
        "product city_style city extended_city prefix push audience sub_audience campaign_date crm_data "
        "join_id account_id campaign_id ad_group_id referrer campaign term content".split(), fill,
    )
    text |= dict.fromkeys(
        "channel mkt_channel mkt_subchannel mkt_medium medium source detailed_source".split(), name
    )
    text |= {"refr_medium": "", "match_type": "na"} | special
    columns = ", ".join(f"'{v}' AS {k}" for k, v in text.items())
    return (
        f"SELECT md5('{key}') AS utm_id, {columns}, 0 AS vertical_type_id, FALSE AS is_lead_provider, "
        f"{internal} AS bin_internal, TIMESTAMP '1970-01-01' AS updated_at, {pbi}::BIGINT AS pbi_utm_id"
    )


_BLANK = dict.fromkeys("referrer campaign term content".split(), "")
CHECKS["seeds"] = "\nUNION ALL BY NAME\n".join(
    [
        _seed("", "direct", "na", _BLANK | {"mkt_channel": "brand", "mkt_medium": "web"}, 1, "NULL"),
        _seed("na", "untracked", "na", {}, 1, "NULL"),
        _seed("timeout", "timeout", "na", {}, 1, "NULL"),
        _seed("loading", "loading", "loading", {"refr_medium": "loading"}, 0, "1"),
    ]
)
CHECKS["channel_dim"] = """
SELECT * FROM {classified_channels} UNION ALL BY NAME SELECT * FROM {seeds}
"""

# --- spend --------------------------------------------------------------------------------------
_COUNTED = ["impressions", "clicks", "reach"]
# Both reports in one shape, then summed per day, ad group and names.
CHECKS["spend"] = f"""
WITH reports AS (
  SELECT 'social' AS refr_medium, 'facebook' AS source, account_name, account_id, campaign_id,
    adset_id AS ad_group_id, 'sp' AS medium, campaign_name AS campaign, adset_name AS term, 'na' AS match_type,
    date, impressions, clicks, reach, spend AS cost
  FROM {{adset_report}}
  UNION ALL BY NAME
  SELECT 'search' AS refr_medium, {_NETWORK} AS source, account_name, account_id, campaign_id, ad_group_id,
    ifnull(said.medium, 'cpc') AS medium, ifnull(said.campaign, campaign_name) AS campaign,
    ifnull(said.term, ad_group_name) AS term, lower(ifnull(string_split(said.term, '_')[1], '')) AS match_type,
    date, impressions, clicks, cost
  FROM {{adgroup_report}} LEFT JOIN (SELECT join_id AS id, medium, campaign, term FROM {{adgroups}}) said
    ON said.id = concat_ws('', account_id, campaign_id, ad_group_id)
), placed AS (
  SELECT * REPLACE (lower(account_id) AS account_id, left(lower(campaign), 255) AS campaign, lower(term) AS term),
    {table([("de", f"refr_medium = 'social' AND regexp_matches(lower(account_name), '^{HOUSE_BRAND}.de$')"),
            ("na", "refr_medium = 'social'"), ("de", "regexp_matches(account_name, '^(?i)(de|germ)')"),
            ("nl", "regexp_matches(account_name, '^(?i)(nl|neth)')")], "na")} AS geo_id
  FROM reports
), summed AS (
  SELECT * EXCLUDE (account_name, cost, {", ".join(_COUNTED)}), round(sum(cost), 4) AS cost,
    {", ".join(f"sum({c})::INT AS {c}" for c in _COUNTED)}
  FROM placed GROUP BY ALL
)
SELECT *, md5(concat(source, source, medium, campaign, term, 'f')) AS utm_id, 'utm-builder' AS tagging_system,
  {bit("campaign", 2)} AS position_2, false AS is_lead_provider, false AS is_home_landing,
  {CITY_STYLE} AS city_style, CASE {bit("campaign", 2)} WHEN 'sn' THEN {bit("campaign", 1, "$")} END AS sn_camp,
  NULL::VARCHAR AS adgroup_id_from_utm, date::TIMESTAMP AS collector_tstamp, source AS refr_host,
  '' AS content, '' AS join_id
FROM summed
"""
CHECKS["spend_in_facts"] = """
SELECT CAST(date AS TIMESTAMP) AS event_at, 'cost' AS fact_type, 'mkt_spend' AS fact_subtype,
  'na' AS session_id, 'na' AS user_id, 0 AS lead_id, date - DATE '1970-01-01' AS date_id,
  0 AS session_did, sp.utm_id, sp.geo_id, ch.vertical_type_id AS marketed_vertical_id,
  0 AS vertical_type_id, sp.cost, sp.impressions, sp.clicks, coalesce(ch.pbi_utm_id, 1) AS pbi_utm_id
FROM {spend} sp LEFT JOIN {spend_channels} ch ON ch.utm_id = sp.utm_id
"""
# channels classified from the spend rows themselves
CHECKS["spend_channels"] = f"""
WITH names AS (
  SELECT utm_id, max_by(struct_pack(campaign, position_2), date) AS newest FROM {{spend}} GROUP BY utm_id
), cut AS (
  SELECT utm_id, newest.position_2 AS position_2, string_split(newest.campaign, '_') AS c,
    'utm-builder' AS tagging_system, false AS is_home_landing, '' AS refr_medium
  FROM names
), named AS (
  SELECT utm_id, {PRODUCT_RAW} AS raw, ifnull(({_RENAMED})[raw], raw) AS product FROM cut
)
SELECT utm_id, {to_int("product", 4)} AS vertical_type_id, NULL::BIGINT AS pbi_utm_id FROM named
"""
CHECKS["spend_by_source"] = """
SELECT geo_id, source, CAST(date AS STRING) AS date, sum(impressions) AS impressions,
  sum(clicks) AS clicks, round(sum(cost), 4) AS cost
FROM {spend} GROUP BY ALL
"""
CHECKS["sheet_prepared"] = """
WITH named AS (
  SELECT *, CASE marketing_channel WHEN 'paid search' THEN 'paid search' WHEN 'native' THEN 'native'
    WHEN 'retargeting' THEN 'display remarketing' ELSE 'undefined' END AS channel
  FROM {sheet_spend}
), sub AS (
  SELECT *, CASE WHEN source IN ('yahoo', 'taboola', 'ligatus') THEN source
    WHEN source = 'bing' AND channel = 'paid search' THEN 'paid search bing '
    WHEN source = 'smt' AND channel = 'display remarketing' THEN 'display retargeting sociomantic'
    ELSE 'undefined' END AS subchannel
  FROM named
)
SELECT date - DATE '1970-01-01' AS date_id, CAST(date AS TIMESTAMP) AS event_at,
  month_spend AS month_cost, spend AS cost, channel, subchannel, source, 'de' AS geo_id,
  md5(channel || subchannel || source) AS utm_id
FROM sub
"""
CHECKS["sheet_in_facts"] = """
SELECT event_at, 'cost' AS fact_type, 'mkt_spend_manual' AS fact_subtype, 'na' AS session_id,
  'na' AS user_id, 0 AS lead_id, date_id, 0 AS session_did, geo_id, 0 AS vertical_type_id, cost, utm_id,
  1 AS pbi_utm_id
FROM {sheet_prepared}
"""
CHECKS["channels_with_sheet"] = """
SELECT utm_id, channel, mkt_channel, mkt_subchannel, source, product, updated_at FROM {channel_dim}
WHERE utm_id NOT IN (SELECT utm_id FROM {sheet_prepared} WHERE utm_id IS NOT NULL)
UNION ALL BY NAME
SELECT DISTINCT utm_id, left(channel, 15) AS channel, channel AS mkt_channel,
  subchannel AS mkt_subchannel, source FROM {sheet_prepared}
"""
CHECKS["city_styles"] = f"""
SELECT event_id, campaign, city_style,
  CASE WHEN campaign LIKE 'gaw%' AND city_style = 'city' THEN {CITY} ELSE 'na' END AS city
FROM {{prepared_channels}}
"""
CHECKS["city_styles_only"] = "SELECT event_id, campaign, city_style FROM {prepared_channels}"
CHECKS["channel_labels"] = """
SELECT utm_id, mkt_subchannel, mkt_channel, channel, product FROM {channel_rule_rows}
"""
CHECKS["last_values"] = """
SELECT DISTINCT ad_group_id, source, medium, campaign, term, content FROM {adgroups}
"""
CHECKS["spend_text"] = "SELECT * REPLACE (CAST(date AS STRING) AS date) FROM {spend}"
CHECKS["adgroups_text"] = """
SELECT * REPLACE (CAST(click_date AS STRING) AS click_date) FROM {adgroups}
"""
CHECKS["clicks_text"] = "SELECT * REPLACE (CAST(date AS STRING) AS date) FROM {clicks_matched}"
