from ..rules.measures import MEASURES

CHECKS = {}


def berlin(ts: str) -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"


# A session starts at an event that is the first of its tracker session on its Berlin day, or that
# comes from another entrance than the last such event or visit from outside did. Every event belongs
# to the user's last start before it. Entrances are looked up by ASOF joins between the few events
# that can start a session.
CHECKS["session_map"] = f"""
WITH numbered AS (
  SELECT e AS hit, strftime({berlin("e.collector_tstamp")}, '%Y%m%d') AS day,
    count(*) OVER (PARTITION BY e.domain_userid
      ORDER BY e.collector_tstamp, e.derived_tstamp, e.event_id, e.event_fingerprint
      ROWS UNBOUNDED PRECEDING) AS place
  FROM {{web_events}} e
  WHERE len([e.domain_userid, e.event_fingerprint, e.event_id]) = len(list_filter(
      [e.domain_userid, e.event_fingerprint, e.event_id], lambda x: x IS NOT NULL))
    AND e.br_renderengine IS DISTINCT FROM 'bot' AND e.app_id IS DISTINCT FROM 'web-internal'
), newest AS (
  SELECT unnest(arg_max(struct_pack(hit, day, place), (hit.collector_tstamp, place)))
  FROM numbered GROUP BY hit.event_id, hit.event_fingerprint
), visits AS (
  SELECT hit.domain_userid AS who, place, day, hit,
    md5(lower(concat(hit.page_url, hit.page_referrer))) AS door,
    hit.refr_medium IS DISTINCT FROM 'internal' AS outside
  FROM newest
), openers AS (
  SELECT who, min(place) AS place FROM visits GROUP BY who, day, hit.domain_sessionid
), doors AS (
  SELECT v.who, v.place, v.day, v.hit.event_id AS event_id, o.place IS NOT NULL AS opens,
    CASE WHEN outside THEN door ELSE 'direct_or_time' END AS door
  FROM visits v LEFT JOIN openers o ON o.who = v.who AND o.place = v.place
  WHERE outside OR o.place IS NOT NULL
), starts AS (
  SELECT d.who, d.place, d.day || '_' || d.event_id AS session_id
  FROM doors d ASOF LEFT JOIN doors earlier ON earlier.who = d.who AND d.place > earlier.place
  WHERE d.opens OR d.door <> earlier.door
)
SELECT s.session_id, hit.event_id AS event_id, hit.event_fingerprint AS event_fingerprint,
  hit.collector_tstamp AS collector_tstamp, v.who AS domain_userid, v.place AS derived_ranking,
  rank() OVER (PARTITION BY v.who, s.place ORDER BY v.place) AS session_event_index,
  outside AS is_external
FROM visits v ASOF JOIN starts s ON s.who = v.who AND v.place >= s.place
"""

# Events of one identity are counted first, each as what it is.
CHECKS["bounds"] = """
WITH hits AS (
  SELECT collector_tstamp, event_id, event_fingerprint, count(*) AS n,
    count(*) FILTER (event = 'transaction') AS t, count(*) FILTER (event = 'page_view') AS p
  FROM {tracked_events} GROUP BY ALL
), ends AS (
  SELECT session_id, domain_userid, sum(n)::BIGINT AS events, sum(t)::BIGINT AS transactions,
    sum(p)::BIGINT AS page_views,
    arg_min(struct_pack(c := collector_tstamp, e := event_id, f := event_fingerprint), derived_ranking) AS one,
    arg_max(struct_pack(c := collector_tstamp, e := event_id, f := event_fingerprint), derived_ranking) AS other
  FROM {session_map} JOIN hits USING (collector_tstamp, event_id, event_fingerprint)
  GROUP BY session_id, domain_userid
)
SELECT session_id, domain_userid, one.c AS start_collector_tstamp, one.e AS start_event_id,
  one.f AS start_event_fingerprint, other.c AS end_collector_tstamp, other.e AS end_event_id,
  other.f AS end_event_fingerprint, events, transactions, page_views
FROM ends
"""
CHECKS["tracked_events"] = "SELECT * FROM {web_events}"
CHECKS["bounds_of_copies"] = CHECKS["bounds"].replace("{tracked_events}", "{events_twice}")
# every 20th event again as it is, and others again as another kind of event
CHECKS["events_twice"] = """
SELECT * FROM {web_events}
UNION ALL SELECT * FROM {web_events} WHERE CAST(event_id AS INT) % 20 = 3
UNION ALL SELECT * REPLACE (CASE event WHEN 'page_view' THEN 'transaction' ELSE 'page_view' END AS event)
FROM {web_events} WHERE CAST(event_id AS INT) % 20 = 7
"""

# fixed values: columns of the first event that a session keeps
_DETAILS = """page_urlhost geo_zipcode geo_latitude geo_longitude geo_region_name useragent br_name br_family br_version br_type
  br_lang br_features_pdf br_viewwidth br_viewheight os_name os_family dvce_type dvce_ismobile dvce_screenwidth
  dvce_screenheight""".split()

# What a session shows is looked up value by value from its first event.
CHECKS["facts_of_sessions"] = f"""
WITH firsts AS (
  SELECT b.*, a AS hit, {berlin("b.start_collector_tstamp")} AS begun,
    (SELECT min(utm_id) FROM {{prepared_channels}} u WHERE u.event_id = b.start_event_id
      AND u.event_fingerprint = b.start_event_fingerprint
      AND u.collector_tstamp = b.start_collector_tstamp) AS tagged,
    (SELECT min(utm_id) FROM {{tv_peaks}} t
      WHERE t.minute = date_trunc('minute', b.start_collector_tstamp)) AS spot,
    (SELECT lower(min(iso_code)) FROM {{iso_country_codes}} i
      WHERE lower(i.country) = lower(a.geo_country)) AS code,
    (SELECT min(struct_pack(l := login_user_id, o := onsite_user_id)) FROM {{user_map}} m
      WHERE m.domain_userid = b.domain_userid) AS login
  FROM {{bounds}} b SEMI JOIN (SELECT session_id, min(domain_userid) AS domain_userid FROM {{bounds}}
    GROUP BY session_id) one USING (session_id, domain_userid)
  LEFT JOIN {{web_events}} a ON (a.event_id, a.event_fingerprint, a.collector_tstamp)
    = (b.start_event_id, b.start_event_fingerprint, b.start_collector_tstamp)
), named AS (
  SELECT *, ifnull(code, '00') AS nation, trim(lower(ifnull(hit.geo_city, ''))) AS town,
    list_filter([tagged, spot, md5(if(hit.refr_medium = 'internal', 'timeout', ''))],
      lambda x: x IS NOT NULL)[1] AS utm_id
  FROM firsts
)
SELECT session_id, start_collector_tstamp, start_event_id, start_event_fingerprint,
  end_collector_tstamp, end_event_id, end_event_fingerprint, domain_userid,
  begun AS start_locale_tstamp, datediff('day', DATE '1970-01-01', begun) AS start_did, utm_id,
  trim(nation || town) AS geo_id, hit.page_url AS landing_page_url, hit.page_title AS landing_page_title,
  hit.page_urlpath AS landing_pagepath, nation AS country,
  town AS city, login.l AS login_user_id, login.o AS onsite_user_id,
  (SELECT min(id) FROM {{utm_ids}} i WHERE i.utm_id = named.utm_id) AS pbi_utm_id,
  {", ".join(f"hit.{c} AS {c}" for c in _DETAILS)},
  datediff('microsecond', start_collector_tstamp, end_collector_tstamp) / 1e6 AS duration_seconds,
  events = 1 AS is_bounce, if(events = 1, 1, 0) AS bin_bounce, events, transactions, page_views
FROM named
"""

CHECKS["conversions"] = f"""
WITH orders AS (
  SELECT tr_orderid, unnest(arg_min(struct_pack(event_id, event_fingerprint, event, collector_tstamp,
    session_id, domain_userid), collector_tstamp))
  FROM (SELECT * FROM {{web_events}} SEMI JOIN (SELECT lead_id::VARCHAR AS tr_orderid FROM {{valid_leads}})
      USING (tr_orderid)) JOIN (SELECT session_id, event_id, event_fingerprint FROM {{session_map}})
    USING (event_id, event_fingerprint)
  WHERE event = 'tr' AND NOT list_contains(['web-localhost', 'web-staging'], app_id)
    AND collector_tstamp < (SELECT max(logged_at) FILTER (runner_title = 'events' AND position_type = 0)
      FROM {{load_log}})
  GROUP BY tr_orderid
)
SELECT *, domain_userid AS onsite_user_id, domain_userid AS login_user_id, 'LEAD' AS conversion_type,
  concat('LEAD-', session_id) AS conversion_path_id,
  {berlin("collector_tstamp")} AS onsite_conversion_locale_tstamp
FROM orders
"""

# Each session leads to the user's next conversion of a kind, if that is at most 90 days and a second
# away. Shares of a conversion follow from the place p of n: both ends of a path share 1, or 0.4 each
# with the rest on the places between.
CHECKS["paths"] = """
WITH goals AS (
  SELECT conversion_path_id, unnest(arg_min(struct_pack(conversion_type, domain_userid, at := collector_tstamp),
    (collector_tstamp, tr_orderid)))
  FROM {conversions} WHERE session_id IS NOT NULL GROUP BY conversion_path_id
), steps AS (
  SELECT g.conversion_path_id, g.conversion_type, s.session_id, s.domain_userid,
    s.utm_id = md5('') AS is_direct, s.start_collector_tstamp AS begun
  FROM (SELECT * FROM {facts_of_sessions}, (SELECT DISTINCT conversion_type AS kind FROM goals)) s
  ASOF JOIN goals g ON g.domain_userid = s.domain_userid AND g.conversion_type = s.kind
    AND s.start_collector_tstamp <= g.at
  WHERE g.at - s.start_collector_tstamp < INTERVAL '7776001' SECOND
), spots AS (
  SELECT * EXCLUDE (begun), count(*) OVER (path ORDER BY begun ROWS UNBOUNDED PRECEDING) AS p,
    count(*) OVER path AS n
  FROM steps WINDOW path AS (PARTITION BY domain_userid, conversion_path_id)
), ends AS (
  SELECT *, (p = 1)::INT AS first, (p = n)::INT AS last,
    CASE WHEN n <= 2 THEN 1.0::DOUBLE / n
      WHEN p IN (1, n) THEN 0.4::DOUBLE ELSE 0.2::DOUBLE / (n - 2) END AS position_based
  FROM spots
), claims AS (
  SELECT *, position_based * (NOT is_direct OR p = 1)::INT AS custom_prep FROM ends
)
SELECT conversion_path_id, conversion_type, session_id, domain_userid, is_direct, p AS path_position,
  n AS path_length, concat(conversion_path_id, '-', p) AS conversion_path_part_id,
  if(p = 1, 'first', if(p = n, 'last', 'middle')) AS interaction_type,
  (first + last) / 2::DOUBLE AS first_last, position_based, first::DOUBLE AS first, last::DOUBLE AS last,
  1::DOUBLE / n AS linear, custom_prep,
  round(round(custom_prep / sum(custom_prep) OVER (PARTITION BY conversion_path_id), 10), 4) AS custom
FROM claims
"""

CHECKS["lead_summary"] = """
SELECT m.*, datediff('day', DATE '1970-01-01', lead_created_at) AS lead_created_did, paths.conversion_path_id
FROM {lead_measures} m LEFT JOIN (SELECT tr_orderid AS order_id, conversion_path_id FROM {conversions}) paths
  ON order_id = m.lead_id::VARCHAR
"""

# A lead without a path counts once, on its own day and channel; each part of a path takes its share.
CHECKS["returns"] = f"""
WITH parts AS (
  SELECT p.conversion_path_id, struct_pack(did := f.start_did, utm := f.utm_id, id := f.session_id, geo := f.geo_id)
    AS visit, p.custom, p.last
  FROM {{paths}} p JOIN {{facts_of_sessions}} f USING (session_id)
), rows AS (
  SELECT l.*, visit, ifnull(custom, 1) AS share, ifnull(last, 1) AS last_share
  FROM {{lead_summary}} l LEFT JOIN parts USING (conversion_path_id)
)
SELECT lead_id, lead_created_at, ifnull(visit.did, lead_created_did) AS date_id,
  coalesce(visit.utm, utm_id, md5('na')) AS utm_id, primary_vertical_type_id AS marketed_vertical_id,
  ifnull(visit.id, 'na') AS session_id, ifnull(visit.geo, geo_id) AS geo_id,
  round(sum(lead_price), 6) AS cost,
  {", ".join(f"round(sum(share * {m}), 6) AS {m}, round(sum(last_share * {m}), 6) AS lc_{m}" for m in MEASURES)}
FROM rows GROUP BY 1, 2, 3, 4, 5, 6, 7
"""

CHECKS["returns_in_facts"] = """
SELECT lead_created_at AS event_at, 'conversion' AS fact_type, 'lead' AS fact_subtype, s.session_id,
  CAST(s.lead_id AS STRING) AS user_id, s.lead_id, s.date_id, s.date_id AS session_did, s.utm_id,
  coalesce(s.geo_id, 'na') AS geo_id,
  coalesce(ch.vertical_type_id, s.marketed_vertical_id, 0) AS marketed_vertical_id,
  0 AS vertical_type_id,
  s.* EXCLUDE (lead_id, lead_created_at, date_id, utm_id, marketed_vertical_id, session_id, geo_id),
  coalesce(ch.pbi_utm_id, 1) AS pbi_utm_id
FROM {returns} s LEFT JOIN {channel_dim} ch ON ch.utm_id = s.utm_id
"""

# --- single operators ---------------------------------------------------------------------------
CHECKS["bot_filter"] = """
SELECT event_id, event, app_id, br_renderengine FROM {web_events}
WHERE domain_userid IS NOT NULL AND event_fingerprint IS NOT NULL AND event_id IS NOT NULL
  AND (br_renderengine IS NULL OR br_renderengine <> 'bot')
  AND (app_id IS NULL OR app_id <> 'web-internal')
"""
CHECKS["event_identity"] = """
SELECT s.session_id, s.event_id, s.collector_tstamp, a.event, a.value
FROM {session_map} s LEFT JOIN {web_events} a ON s.collector_tstamp = a.collector_tstamp
  AND a.event_id = s.event_id AND s.event_fingerprint = a.event_fingerprint
"""
CHECKS["tv_peak"] = """
SELECT e.event_id, e.collector_tstamp, tv.utm_id
FROM {web_events} e LEFT JOIN {tv_peaks} tv ON date_trunc('minute', e.collector_tstamp) = tv.minute
"""
CHECKS["latest"] = """
SELECT domain_userid, event_id, collector_tstamp, event FROM {web_events}
WHERE domain_userid IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY domain_userid ORDER BY collector_tstamp DESC, event_id) = 1
"""
CHECKS["valid_orders"] = """
SELECT event_id, tr_orderid, value FROM {web_events}
WHERE tr_orderid IN (SELECT CAST(lead_id AS STRING) FROM {valid_leads})
"""
CHECKS["path_places"] = """
SELECT conversion_path_id, conversion_type, session_id, domain_userid, path_position, path_length
FROM {paths}
"""
CHECKS["streamed_sessions"] = """
SELECT session_id, event_id, collector_tstamp, session_event_index, is_external FROM {session_map}
"""
CHECKS["tracker_sessions"] = """
WITH gaps AS (
  SELECT domain_userid, collector_tstamp, CASE WHEN collector_tstamp - lag(collector_tstamp) OVER (
    PARTITION BY domain_userid ORDER BY collector_tstamp) <= INTERVAL '1800' SECOND THEN 0 ELSE 1 END AS opens
  FROM {web_events} WHERE domain_userid IS NOT NULL
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY domain_userid ORDER BY collector_tstamp
    ROWS UNBOUNDED PRECEDING) AS no FROM gaps
)
SELECT domain_userid, min(collector_tstamp) AS start_at, max(collector_tstamp) AS end_at, count(*) AS events
FROM numbered GROUP BY domain_userid, no
"""
