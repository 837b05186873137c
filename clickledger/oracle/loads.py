CHECKS = {}

# Rows up to a cut are the target; those from a day before it, changed, are the stage.
_CUT = "TIMESTAMP '2024-01-20'"
CHECKS["target_events"] = f"""
SELECT event_id, collector_tstamp, domain_userid, event, value FROM {{web_events}}
WHERE collector_tstamp < {_CUT}
"""
CHECKS["stage_events"] = f"""
SELECT event_id, collector_tstamp, domain_userid, event, value + 1000 AS value FROM {{web_events}}
WHERE collector_tstamp >= {_CUT} - INTERVAL '1' DAY
"""
CHECKS["upserted"] = """
SELECT * FROM {target_events} WHERE event_id NOT IN (SELECT event_id FROM {stage_events})
UNION ALL SELECT * FROM {stage_events}
"""
CHECKS["tail_replaced"] = """
SELECT * FROM {target_events}
WHERE collector_tstamp < (SELECT min(collector_tstamp) FROM {stage_events})
UNION ALL SELECT * FROM {stage_events}
"""
CHECKS["unseen_appended"] = """
SELECT * FROM {target_events}
UNION ALL SELECT * FROM {stage_events} WHERE event_id NOT IN (SELECT event_id FROM {target_events})
"""
CHECKS["slice_replaced"] = """
SELECT * FROM {target_events} WHERE NOT coalesce(event = 'tr' AND collector_tstamp >= (
  SELECT min(collector_tstamp) FROM {stage_events} WHERE event = 'tr'), FALSE)
UNION ALL SELECT * FROM {stage_events} WHERE event = 'tr'
"""
CHECKS["window_of_run"] = """
SELECT event_id, collector_tstamp FROM {web_events}
WHERE collector_tstamp >= (
    SELECT (date_trunc('day', max(collector_tstamp)) AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC'
    FROM {target_events})
  AND collector_tstamp <= (SELECT max(logged_at) FROM {load_log} WHERE job_title = 'events_start')
"""
CHECKS["changed"] = """
WITH since AS (SELECT max(etl_at) - INTERVAL '3' HOUR AS cut_at FROM (SELECT TIMESTAMP '2024-01-20' AS etl_at))
SELECT DISTINCT lead_id FROM (
  SELECT CAST(backend_opportunity_id AS BIGINT) AS lead_id FROM {crm_leads}
    WHERE id IN (SELECT legacy_lead_id FROM {crm_opportunities}, since WHERE last_modified_date > cut_at)
  UNION ALL
  SELECT CAST(tr_orderid AS BIGINT) FROM {conversions}, since WHERE collector_tstamp > cut_at
  UNION ALL
  SELECT CAST(backend_opportunity_id AS BIGINT) FROM {crm_leads}, since WHERE last_modified_date > cut_at
)
"""
CHECKS["repaired_urls"] = r"""
WITH raw AS (SELECT event_id, collector_tstamp, page_url,
  CASE WHEN CAST(event_id AS INT) % 2 = 0 THEN 'https:' END AS old_scheme, page_urlhost AS old_host
  FROM {web_events}),
cut AS (SELECT *, split_part(page_url, '#', 2) AS frag FROM raw)
SELECT event_id, page_url,
  CASE WHEN old_scheme IS NULL THEN regexp_extract(page_url, '^((http[s]?|ftp):)', 0) ELSE old_scheme END
    AS page_urlscheme,
  CASE WHEN old_scheme IS NULL THEN split_part(regexp_extract(page_url, '([^:/\s]+)((/\w+)*/)', 0), '/', 1)
    ELSE old_host END AS page_urlhost,
  CASE WHEN old_scheme IS NULL THEN '/' || split_part(split_part(split_part(page_url, '.com/', 2), '?', 1), '#', 1)
    END AS page_urlpath,
  CASE WHEN old_scheme IS NULL THEN split_part(split_part(page_url, '?', 2), '#', 1) END AS page_urlquery,
  CASE WHEN old_scheme IS NULL AND frag <> '' THEN '#' || frag END AS page_urlfragment
FROM cut
"""
CHECKS["page_parts"] = r"""
SELECT page_id, regexp_extract(url, '^((http[s]?|ftp):)', 0) AS page_urlscheme,
  split_part(regexp_extract(url, '([^:/\s]+)((/\w+)*/)', 0), '/', 1) AS page_urlhost,
  '/' || split_part(split_part(split_part(url, '.com/', 2), '?', 1), '#', 1) AS page_urlpath,
  split_part(split_part(url, '?', 2), '#', 1) AS page_urlquery,
  CASE WHEN split_part(url, '#', 2) <> '' THEN '#' || split_part(url, '#', 2) END AS page_urlfragment
FROM pages
"""


def _param(name: str) -> str:
    pairs = "string_split(regexp_extract(page_url, '\\?([^#]*)', 1), '&')"
    found = f"list_filter({pairs}, lambda p: regexp_matches(p, '^{name}=.+'))[-1]"
    return f"url_decode(replace(substr({found}, {len(name) + 2}), '+', ' '))"


_UTM = {"mkt_medium": "utm_medium", "mkt_source": "utm_source", "mkt_campaign": "utm_campaign",
        "mkt_term": "utm_term", "mkt_content": "utm_content", "mkt_clickid": "gclid"}
CHECKS["utm_filled"] = f"""
SELECT event_id, {", ".join(
    f"CASE WHEN mkt_source IS NULL AND page_url LIKE '%?%' THEN {_param(p)} ELSE {c} END AS {c}"
    for c, p in _UTM.items())}
FROM {{web_events}} WHERE collector_tstamp > TIMESTAMP '2017-06-12'
"""
CHECKS["stamps"] = """
SELECT event_id, raw_value,
  CASE WHEN raw_value LIKE '____-__-__' THEN CAST(raw_value AS TIMESTAMP)
    ELSE epoch_ms(TRY_CAST(left(raw_value, 10) AS BIGINT) * 1000) END AS as_number_or_date,
  CASE CAST(event_id % 8 AS INT) WHEN 0 THEN TIMESTAMP '2018-03-04' WHEN 3 THEN TIMESTAMP '2018-03-04 05:06:07'
    WHEN 4 THEN TIMESTAMP '2018-03-04 05:06:07.5' WHEN 5 THEN TIMESTAMP '2018-04-05'
    WHEN 6 THEN TIMESTAMP '2018-03-04' END AS as_text
FROM {raw_stamps}
"""
CHECKS["props"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS STRING) AS missing FROM {raw_stamps}
"""
CHECKS["order_sums"] = """
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total FROM (
  SELECT DISTINCT o_orderkey, o_orderstatus, o_totalprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
GROUP BY 1
"""
CHECKS["snapshots"] = """
SELECT event, count(*) AS n, round(sum(value), 4) AS value, TIMESTAMP '2024-02-01' AS loaded_at
FROM {web_events} GROUP BY 1
"""
CHECKS["events_by_kind"] = """
SELECT event, count(*) AS n, round(sum(value), 4) AS value FROM {web_events} GROUP BY event
"""
CHECKS["views_only"] = """
SELECT event_id, event, value FROM {web_events} WHERE event = 'page_view'
"""
CHECKS["slices"] = """
SELECT event_id, event, round(if(event = 'tr', 2 * value, value), 4) AS value FROM {web_events}
WHERE event NOT IN ('transaction')
"""
CHECKS["audited"] = """
SELECT if(good, 'event', 'error') AS event_type, 'Realtime Push' AS event_category, (NOT good)::INT AS is_error,
  if(good, (SELECT count(*) FROM {web_events}), 0) AS rows_processed, 1 AS is_etl, good AS is_good,
  NOT good AS names_the_fault
FROM (VALUES (true), (false)) t(good)
"""
CHECKS["ids_once"] = """
SELECT DISTINCT event_id, event_fingerprint, event FROM {web_events}
"""
