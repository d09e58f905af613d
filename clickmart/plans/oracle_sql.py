"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the operator semantics, not generated from the Spark
code: the feeds are re-derived from ``events`` in SQL, the purchases table is
a brute-force self-join and the segment mart keeps its two-level form. Column
names match the Spark results; sums are cast to BIGINT (DuckDB widens them).
"""

from __future__ import annotations

from clickmart.plans import params as P

_EID = "'00000000-0000-4000-8000-' || lpad(CAST({x} AS VARCHAR), 12, '0')"
_SID = "'00000000-0000-4000-9000-' || lpad(CAST(user_id * 100 + day(ts) AS VARCHAR), 12, '0')"

FEEDS = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events
),
browser_events AS (
  SELECT {_EID.format(x='event_id')} AS event_id,
         ts AS event_timestamp,
         'pageview' AS event_type,
         {_SID} AS click_id,
         CASE user_id % 3 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' ELSE 'Safari' END AS browser_name,
         'UA/' || CAST(user_id % 7 AS VARCHAR) AS browser_user_agent,
         CASE user_id % 2 WHEN 0 THEN 'en_US' ELSE 'de_DE' END AS browser_language
  FROM ev
),
location_events AS (
  SELECT {_EID.format(x='event_id')} AS event_id,
         'http://shop.example.com/' || CAST(k AS VARCHAR) AS page_url,
         CASE WHEN event_type = 'view' THEN '/product_' || CAST(k % 20 AS VARCHAR)
              WHEN event_type = 'purchase' THEN '/confirmation'
              WHEN event_type = 'signup' THEN '/payment'
              WHEN event_type = 'click' THEN (CASE WHEN k % 2 = 0 THEN '/home' ELSE '/cart' END)
              ELSE '/error' END AS page_url_path,
         CASE k % 3 WHEN 0 THEN 'www.a.example' WHEN 1 THEN 'www.b.example' ELSE 'www.c.example' END AS referer_url,
         CASE k % 2 WHEN 0 THEN 'internal' ELSE 'search' END AS referer_medium,
         CASE k % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'cpc' ELSE 'email' END AS utm_medium,
         CASE k % 4 WHEN 0 THEN 'facebook' WHEN 1 THEN 'google' WHEN 2 THEN 'bing' END AS utm_source,
         'ad_' || CAST(k % 5 AS VARCHAR) AS utm_content,
         'campaign_' || CAST(k % 6 AS VARCHAR) AS utm_campaign
  FROM ev
),
device_events AS (
  SELECT {_SID} AS click_id,
         'os-' || CAST(user_id % 11 AS VARCHAR) AS os,
         CASE user_id % 4 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' ELSE 'Linux' END AS os_name,
         'Europe/Berlin' AS os_timezone,
         CASE WHEN user_id % 4 < 2 THEN 'Mobile' ELSE 'Computer' END AS device_type,
         user_id % 4 < 2 AS device_is_mobile,
         'u' || CAST(user_id AS VARCHAR) || '@example.com' AS user_custom_id,
         {_EID.format(x='user_id')} AS user_domain_id
  FROM ev
),
geo_events AS (
  SELECT {_SID} AS click_id,
         CAST(user_id % 90 AS VARCHAR) AS geo_latitude,
         CAST(user_id % 180 AS VARCHAR) AS geo_longitude,
         CASE WHEN user_id % 3 = 0 THEN 'DE' ELSE 'US' END AS geo_country,
         'Europe/Berlin' AS geo_timezone,
         'R' || CAST(user_id % 9 AS VARCHAR) AS geo_region_name,
         '10.0.0.' || CAST(user_id % 50 AS VARCHAR) AS ip_address
  FROM ev
)"""

STAGE = """
s_conversion AS (
  SELECT m.session_id, l.referer_url, l.referer_medium, l.utm_medium, l.utm_source,
         l.utm_content, l.utm_campaign
  FROM (SELECT b.click_id AS session_id, max(b.event_id) AS event_id
        FROM browser_events b
        WHERE b.event_id IN (SELECT event_id FROM location_events)
        GROUP BY b.click_id) m
  JOIN location_events l ON l.event_id = m.event_id
),
s_devices AS (
  SELECT DISTINCT click_id AS session_id, os_name, os_timezone, device_type, user_custom_id, user_domain_id
  FROM device_events
),
s_events AS (
  SELECT DISTINCT click_id AS session_id, event_id, event_timestamp, browser_name FROM browser_events
),
s_events_basic AS (
  SELECT DISTINCT click_id AS session_id, event_id, event_timestamp FROM browser_events
),
s_geo AS (
  SELECT DISTINCT click_id AS session_id, geo_latitude, geo_longitude, geo_country, geo_timezone,
         geo_region_name, ip_address
  FROM geo_events
),
s_session_info AS (
  SELECT DISTINCT click_id AS session_id, browser_name, browser_user_agent, browser_language
  FROM browser_events
),
s_transitions AS (
  SELECT l.event_id, b.click_id AS session_id, l.page_url, b.browser_name, l.page_url_path, b.event_timestamp
  FROM location_events l JOIN browser_events b ON b.event_id = l.event_id
),
s_transitions_basic AS (
  SELECT l.event_id, l.page_url, l.page_url_path, b.event_timestamp
  FROM location_events l JOIN browser_events b ON b.event_id = l.event_id
),
pe AS (
  SELECT b.click_id, b.event_id, b.event_timestamp, l.page_url_path
  FROM browser_events b JOIN location_events l ON l.event_id = b.event_id
),
p_conf AS (
  SELECT row_number() OVER () AS rid, click_id, event_id, event_timestamp
  FROM pe WHERE page_url_path = '/confirmation'
),
p_n AS (
  SELECT c.rid, c.event_id, c.event_timestamp, greatest(1, count(p.event_timestamp)) AS n
  FROM p_conf c
  LEFT JOIN pe p ON p.click_id = c.click_id AND p.page_url_path LIKE '/product_%'
                AND p.event_timestamp < c.event_timestamp
  GROUP BY c.rid, c.event_id, c.event_timestamp
),
p_pc AS (
  SELECT event_id, event_timestamp, sum(n) AS pc FROM p_n GROUP BY event_id, event_timestamp
),
p_cum AS (
  SELECT row_number() OVER () AS rid, c.click_id, c.event_timestamp, x.pc
  FROM p_conf c JOIN p_pc x ON x.event_id = c.event_id
),
s_purchases AS (
  SELECT a.click_id AS session_id, a.event_timestamp,
         CAST(a.pc - coalesce(max(e.pc), 0) AS BIGINT) AS product_count
  FROM p_cum a
  LEFT JOIN p_cum e ON e.click_id = a.click_id AND e.event_timestamp < a.event_timestamp
  GROUP BY a.rid, a.click_id, a.event_timestamp, a.pc
)"""

_LABEL = """CASE WHEN page_url_path LIKE '/product_%' THEN 'add product'
              WHEN page_url_path = '/home' THEN 'go home'
              WHEN page_url_path = '/payment' THEN 'payment cart'
              WHEN page_url_path = '/cart' THEN 'go cart'
              WHEN page_url_path = '/confirmation' THEN 'confirmation payment' END"""

MARTS = f"""
m_campaigns AS (
  SELECT c.utm_campaign, c.utm_medium, date_trunc('hour', p.event_timestamp) AS date_part,
         CAST(sum(p.product_count) AS BIGINT) AS sm
  FROM s_purchases p JOIN s_conversion c ON c.session_id = p.session_id
  GROUP BY c.utm_campaign, c.utm_medium, date_trunc('hour', p.event_timestamp)
),
m_campaigns_basic AS (
  SELECT c.utm_campaign, date_trunc('hour', p.event_timestamp) AS date_part,
         CAST(sum(p.product_count) AS BIGINT) AS sm
  FROM s_purchases p JOIN s_conversion c ON c.session_id = p.session_id
  GROUP BY c.utm_campaign, date_trunc('hour', p.event_timestamp)
),
m_sources AS (
  SELECT c.utm_source, date_trunc('hour', p.event_timestamp) AS date_part,
         CAST(sum(p.product_count) AS BIGINT) AS sm
  FROM s_purchases p JOIN s_conversion c ON c.session_id = p.session_id
  GROUP BY c.utm_source, date_trunc('hour', p.event_timestamp)
),
m_events AS (
  SELECT {_LABEL} AS event, date_trunc('hour', t.event_timestamp) AS date_part,
         d.os_name, d.device_type, t.browser_name, count(*) AS cnt
  FROM s_transitions t JOIN s_devices d ON d.session_id = t.session_id
  GROUP BY ALL
),
m_events_basic AS (
  SELECT {_LABEL} AS event, date_trunc('hour', event_timestamp) AS date_part, count(*) AS cnt
  FROM s_transitions GROUP BY ALL
),
m_sales AS (
  SELECT date_trunc('hour', event_timestamp) AS date_part, CAST(sum(product_count) AS BIGINT) AS cnt
  FROM s_purchases GROUP BY 1
),
m_products AS (
  SELECT substring(page_url_path, strpos(page_url_path, '_') + 1) AS product, count(*) AS cnt
  FROM s_transitions WHERE page_url_path LIKE '/product_%' GROUP BY 1
),
m_users_purchases AS (
  SELECT device_type, utm_source, os_name, CAST(sum(products) AS BIGINT) AS products
  FROM (SELECT date_trunc('hour', p.event_timestamp) AS hr, d.user_custom_id, d.device_type,
               c.utm_source, d.os_name, sum(p.product_count) AS products
        FROM s_purchases p
        JOIN s_devices d ON d.session_id = p.session_id
        JOIN s_conversion c ON c.session_id = p.session_id
        GROUP BY ALL) x
  GROUP BY device_type, utm_source, os_name
),
m_users AS (
  SELECT d.os_name, d.device_type, c.utm_source, count(DISTINCT d.user_custom_id) AS users
  FROM s_devices d JOIN s_conversion c ON c.session_id = d.session_id
  GROUP BY ALL
)"""


def _lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _in(col: str, values) -> str:
    vals = list(values)
    nn = [v for v in vals if v is not None]
    cond = f"{col} IN ({', '.join(_lit(v) for v in nn)})" if nn else "FALSE"
    if len(nn) != len(vals):
        cond = f"({cond} OR {col} IS NULL)"
    return cond


_RANGE = f"date_part BETWEEN TIMESTAMP '{P.REPORT_START}' AND TIMESTAMP '{P.REPORT_END}'"


def _pivot(src: str, col: str, value: str, values) -> str:
    cells = ",\n  ".join(
        f"CAST(coalesce(sum(CASE WHEN {col} = {_lit(v)} THEN {value} END), 0) AS BIGINT) AS \"{v}\""
        for v in values)
    return f"SELECT date_part,\n  {cells}\nFROM {src} WHERE {col} IS NOT NULL AND date_part IS NOT NULL GROUP BY date_part"


def _share(src: str, value: str) -> str:
    return (f"SELECT *, round(100.0 * CAST({value} AS DOUBLE) / CAST(sum({value}) OVER () AS DOUBLE), 1) AS share "
            f"FROM {src}")


_EVENTS_FILTERED = (f"(SELECT * FROM m_events WHERE {_RANGE} AND {_in('event', P.FILTER_EVENTS)} "
                    f"AND {_in('os_name', P.FILTER_OS)} AND {_in('browser_name', P.FILTER_BROWSERS)})")
_USERS_FILTER = f"{_in('os_name', P.USERS_OS)} AND {_in('utm_source', P.USERS_SOURCES)}"
_CAMPAIGNS = f"(SELECT * FROM m_campaigns WHERE {_RANGE} AND {_in('utm_campaign', P.CAMPAIGNS)})"

BODIES: dict[str, str] = {
    "stage_conversion": "SELECT * FROM s_conversion",
    "stage_devices": "SELECT * FROM s_devices",
    "stage_events": "SELECT * FROM s_events",
    "stage_events_basic": "SELECT * FROM s_events_basic",
    "stage_geo": "SELECT * FROM s_geo",
    "stage_purchases": "SELECT * FROM s_purchases",
    "stage_session_info": "SELECT * FROM s_session_info",
    "stage_transitions": "SELECT * FROM s_transitions",
    "stage_transitions_basic": "SELECT * FROM s_transitions_basic",
    "mart_campaign_purchases_hourly": "SELECT * FROM m_campaigns",
    "mart_campaign_purchases_basic": "SELECT * FROM m_campaigns_basic",
    "mart_source_purchases_hourly": "SELECT * FROM m_sources",
    "mart_events_distribution_hourly": "SELECT * FROM m_events",
    "mart_events_distribution_basic": "SELECT * FROM m_events_basic",
    "mart_products_purchased_hourly": "SELECT * FROM m_sales",
    "mart_top_products": "SELECT * FROM m_products",
    "mart_users_purchases_segments": "SELECT * FROM m_users_purchases",
    "mart_users_segments": "SELECT * FROM m_users",
    "explore_wide_events": """
SELECT b.event_id, b.click_id, b.event_timestamp, b.event_type, b.browser_name,
       d.os_name, d.device_type, d.user_custom_id, g.geo_country, g.geo_region_name,
       l.page_url_path, l.referer_medium, l.utm_source, l.utm_campaign, l.utm_medium
FROM browser_events b
LEFT JOIN device_events d ON d.click_id = b.click_id
LEFT JOIN geo_events g ON g.click_id = b.click_id
LEFT JOIN location_events l ON l.event_id = b.event_id""",
    "explore_source_counts": """
SELECT 'browser_events' AS source, count(*) AS cnt FROM browser_events
UNION ALL SELECT 'device_events', count(*) FROM device_events
UNION ALL SELECT 'geo_events', count(*) FROM geo_events
UNION ALL SELECT 'location_events', count(*) FROM location_events""",
    "explore_session_journey": f"""
SELECT b.click_id, b.event_id, b.event_timestamp, b.browser_name, l.page_url_path,
       l.utm_medium, l.utm_source, l.utm_content, l.utm_campaign
FROM browser_events b JOIN location_events l ON l.event_id = b.event_id
WHERE b.click_id = {_lit(P.JOURNEY_SESSION)}
ORDER BY b.event_timestamp, b.event_id""",
    "explore_ip_sessions": f"""
SELECT ip_address, count(*) AS cnt
FROM (SELECT g.ip_address, g.click_id, d.user_domain_id, d.user_custom_id
      FROM geo_events g
      JOIN device_events d ON d.click_id = g.click_id
      JOIN browser_events b ON b.click_id = g.click_id
      GROUP BY 1, 2, 3, 4) t
GROUP BY ip_address
ORDER BY cnt DESC, ip_address ASC NULLS LAST
LIMIT {P.TOP_IPS}""",
    "explore_ip_detail": f"""
SELECT g.ip_address, g.click_id, d.user_domain_id, d.user_custom_id, d.device_type, count(*) AS cnt
FROM geo_events g
JOIN device_events d ON d.click_id = g.click_id
JOIN browser_events b ON b.click_id = g.click_id
WHERE g.ip_address = {_lit(P.DETAIL_IP)}
GROUP BY 1, 2, 3, 4, 5""",
    "ingest_json_location_events": "SELECT * FROM location_events",
    "report_date_range": f"SELECT * FROM m_events WHERE {_RANGE}",
    "report_distinct_values": f"""
SELECT DISTINCT 'os_name' AS field, os_name AS value FROM m_events
UNION ALL SELECT DISTINCT 'device_type', device_type FROM m_events
UNION ALL SELECT DISTINCT 'browser_name', browser_name FROM m_events
UNION ALL SELECT DISTINCT 'event', event FROM m_events WHERE {_RANGE}
UNION ALL SELECT DISTINCT 'utm_campaign', utm_campaign FROM m_campaigns WHERE {_RANGE}
UNION ALL SELECT DISTINCT 'utm_source', utm_source FROM m_users""",
    "report_multi_filter": f"SELECT * FROM {_EVENTS_FILTERED}",
    "report_events_pivot": _pivot(_EVENTS_FILTERED, "event", "cnt",
                                  [e for e in P.FILTER_EVENTS if e is not None]),
    "report_events_detail": f"SELECT * FROM {_EVENTS_FILTERED} ORDER BY date_part DESC",
    "report_sales_hourly": f"SELECT * FROM m_sales WHERE {_RANGE} ORDER BY date_part",
    "report_sales_trend": f"""
SELECT date_part, cnt, idx,
       round(regr_intercept(cnt, idx) OVER () + regr_slope(cnt, idx) OVER () * idx, 6) AS trend
FROM (SELECT date_part, cnt, row_number() OVER (ORDER BY date_part) - 1 AS idx
      FROM m_sales WHERE {_RANGE})""",
    "report_sales_kpis": f"""
SELECT CAST(sum(cnt) AS BIGINT) AS total_sales, avg(cnt) AS avg_sales, CAST(max(cnt) AS BIGINT) AS max_sales
FROM m_sales WHERE {_RANGE} HAVING count(*) > 0""",
    "report_top_products": f"""
SELECT product, cnt AS views FROM m_products ORDER BY cnt DESC, product ASC NULLS LAST LIMIT {P.TOP_N}""",
    "report_source_totals": _share(
        f"(SELECT utm_source, CAST(sum(sm) AS BIGINT) AS sm FROM m_sources "
        f"WHERE {_RANGE} AND utm_source IS NOT NULL GROUP BY utm_source)", "sm"),
    "report_source_pivot": _pivot(f"(SELECT * FROM m_sources WHERE {_RANGE})", "utm_source", "sm",
                                  P.SOURCES),
    "report_users_by_source": _share(
        f"(SELECT utm_source, CAST(sum(users) AS BIGINT) AS users FROM m_users "
        f"WHERE {_USERS_FILTER} AND utm_source IS NOT NULL GROUP BY utm_source)", "users"),
    "report_campaign_pivot": _pivot(_CAMPAIGNS, "utm_campaign", "sm", P.CAMPAIGNS),
    "report_campaign_comparison": f"""
SELECT utm_campaign, CAST(sum(sm) AS BIGINT) AS "sum", avg(sm) AS "mean", count(sm) AS "count"
FROM {_CAMPAIGNS} WHERE utm_campaign IS NOT NULL GROUP BY utm_campaign""",
    "report_users_by_os_device": f"""
SELECT os_name, device_type, CAST(sum(users) AS BIGINT) AS users FROM m_users
WHERE {_USERS_FILTER} AND os_name IS NOT NULL AND device_type IS NOT NULL
GROUP BY os_name, device_type""",
    "report_products_by_source": f"""
SELECT utm_source, CAST(sum(products) AS BIGINT) AS products FROM m_users_purchases
WHERE {_USERS_FILTER} AND utm_source IS NOT NULL GROUP BY utm_source""",
    "report_overall_kpis": """
SELECT (SELECT CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM m_events) AS total_events,
       (SELECT CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM m_sales) AS total_purchases,
       (SELECT count(*) FROM m_products) AS total_products""",
}

BODIES["ingest_json_feed_counts"] = BODIES["explore_source_counts"]
BODIES["ingest_raw_counts"] = BODIES["explore_source_counts"]
BODIES["pipeline_campaign_purchases"] = BODIES["mart_campaign_purchases_hourly"]
BODIES["pipeline_mart_counts"] = """
SELECT 'campaign_purchase_analysis_hourly' AS source, count(*) AS cnt FROM m_campaigns
UNION ALL SELECT 'click_conversion_rates_hourly', count(*) FROM m_sources
UNION ALL SELECT 'events_distribution_hourly', count(*) FROM m_events
UNION ALL SELECT 'purchased_products_count_hourly', count(*) FROM m_sales
UNION ALL SELECT 'top_performing_products', count(*) FROM m_products
UNION ALL SELECT 'users_segments_agg', count(*) FROM m_users
UNION ALL SELECT 'users_purchases_segments_agg', count(*) FROM m_users_purchases"""

BODIES["mart_users_segments_merged"] = BODIES["mart_users_segments"]
BODIES["mart_users_segments_range"] = f"""
SELECT d.os_name, d.device_type, c.utm_source, count(DISTINCT d.user_custom_id) AS users
FROM s_devices d JOIN s_conversion c ON c.session_id = d.session_id JOIN s_events e ON e.session_id = d.session_id
WHERE date_trunc('hour', e.event_timestamp) BETWEEN TIMESTAMP '{P.REPORT_START}' AND TIMESTAMP '{P.REPORT_END}'
GROUP BY ALL"""
# every chain of pages in order, by self-joins
BODIES["explore_session_funnel"] = """
SELECT device_type, CAST(step AS INTEGER) AS step, name, count(DISTINCT session_id) AS sessions
FROM (SELECT DISTINCT session_id, device_type FROM s_devices) JOIN (
  WITH p AS (SELECT session_id, event_timestamp AS t, CASE WHEN page_url_path LIKE '/product_%' THEN 0 WHEN page_url_path = '/cart' THEN 1
                    WHEN page_url_path = '/payment' THEN 2 WHEN page_url_path = '/confirmation' THEN 3 END AS step FROM s_transitions)
  SELECT session_id, 0 AS step, 'product' AS name FROM p WHERE step = 0
  UNION ALL SELECT a.session_id, 1, 'cart' FROM p a JOIN p b ON a.session_id = b.session_id AND a.t < b.t WHERE a.step = 0 AND b.step = 1
  UNION ALL SELECT a.session_id, 2, 'payment' FROM p a JOIN p b ON a.session_id = b.session_id AND a.t < b.t
            JOIN p c ON b.session_id = c.session_id AND b.t < c.t WHERE a.step = 0 AND b.step = 1 AND c.step = 2
  UNION ALL SELECT a.session_id, 3, 'confirmation' FROM p a JOIN p b ON a.session_id = b.session_id AND a.t < b.t
            JOIN p c ON b.session_id = c.session_id AND b.t < c.t JOIN p d ON c.session_id = d.session_id AND c.t < d.t
            WHERE a.step = 0 AND b.step = 1 AND c.step = 2 AND d.step = 3) USING (session_id)
GROUP BY ALL"""

# A file per feed and day, named by the day's first hour; the load report has one day more.
_DAYS = """
SELECT f.feed, d.day, coalesce(n.rows, 0) AS n, coalesce(n.broken, 0) AS broken, coalesce(n.even, 0) AS even
FROM (VALUES ('browser_events'), ('device_events'), ('geo_events'), ('location_events')) f(feed)
CROSS JOIN (SELECT unnest(generate_series((SELECT min(date_trunc('day', ts)) FROM events), (SELECT max(date_trunc('day', ts)) FROM events) + INTERVAL 1 DAY,
                                          INTERVAL 1 DAY))::TIMESTAMP AS day) d
LEFT JOIN (SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS rows, count(*) FILTER (event_id % {every} = 0) AS broken,
                  count(*) FILTER (event_id % 2 = 0) AS even FROM events GROUP BY 1) n ON n.day = d.day""".format(every=P.BROKEN_EVERY)
_FILE = "strftime(day, '%Y-') || CAST(month(day) AS VARCHAR) || strftime(day, '-%d-H%H.jsonl')"
BODIES["ingest_load_report"] = f"""
SELECT feed, day AS load_hour, CASE WHEN n = 0 THEN 'skipped' ELSE 'loaded' END AS status, n AS rows,
       CASE WHEN feed = 'location_events' THEN broken ELSE 0 END AS corrupt_rows,
       n - CASE WHEN feed = 'location_events' THEN broken ELSE 0 END AS parsed_rows
FROM ({_DAYS})"""
BODIES["ingest_backfill_ledger"] = f"""
SELECT feed, day AS load_hour, {_FILE} AS delivery, n AS rows, CASE WHEN day = min(day) OVER () THEN 2 ELSE 1 END AS loads
FROM ({_DAYS}) WHERE n > 0"""
BODIES["ingest_hour_states"] = f"""
SELECT feed, day AS load_hour, 'data/' || feed || '/' || {_FILE} AS path, CASE WHEN n = 0 THEN 'missing' ELSE 'new' END AS state
FROM ({_DAYS})"""
BODIES["ingest_zip_feed"] = BODIES["ingest_json_location_events"]
BODIES["ingest_stream_counts"] = BODIES["explore_source_counts"]
_COUNTS = {"raw": ("browser_events", "device_events", "geo_events", "location_events"),
           "stage": {"conversion": "s_conversion", "devices": "s_devices", "events": "s_events", "geo": "s_geo", "purchases": "s_purchases",
                     "session_info": "s_session_info", "transitions": "s_transitions"},
           "mart": {"campaign_purchase_analysis_hourly": "m_campaigns", "click_conversion_rates_hourly": "m_sources",
                    "events_distribution_hourly": "m_events", "purchased_products_count_hourly": "m_sales",
                    "top_performing_products": "m_products", "users_segments_agg": "m_users", "users_purchases_segments_agg": "m_users_purchases"}}
BODIES["ingest_catalog"] = "\nUNION ALL ".join(
    [f"SELECT 'raw' AS layer, '{t}' AS name, count(*) AS rows FROM {t}" for t in _COUNTS["raw"]]
    + [f"SELECT 'raw', '{t}_rejected', 0" for t in _COUNTS["raw"]]
    + [f"SELECT '{layer}', '{name}', count(*) FROM {source}" for layer in ("stage", "mart") for name, source in _COUNTS[layer].items()])


def _long(mart: str, source: str, keys: str, value: str) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '~')" for k in keys.split())
    return f"SELECT '{mart}' AS mart, {text} AS key, CAST({value} AS BIGINT) AS value FROM {source}"


BODIES["pipeline_backfill"] = "\nUNION ALL ".join((
    _long("campaign_purchase_analysis_hourly", "m_campaigns", "utm_campaign utm_medium date_part", "sm"),
    _long("click_conversion_rates_hourly", "m_sources", "utm_source date_part", "sm"),
    _long("events_distribution_hourly", "m_events", "event date_part os_name device_type browser_name", "cnt"),
    _long("purchased_products_count_hourly", "m_sales", "date_part", "cnt"),
    _long("top_performing_products", "m_products", "product", "cnt"),
    _long("users_segments_agg", "m_users", "os_name device_type utm_source", "users"),
    _long("users_purchases_segments_agg", "m_users_purchases", "device_type utm_source os_name", "products")))
BODIES["pipeline_incremental"] = BODIES["pipeline_backfill"]
BODIES["report_cached_sales"] = BODIES["report_sales_hourly"]

_PREFIX = "WITH " + ",".join([FEEDS, STAGE, MARTS]) + "\n"


# The same over the events of the first day alone.
_FIRST_DAY = _PREFIX.replace("FROM events\n", "FROM events WHERE ts < (SELECT min(date_trunc('day', ts)) + INTERVAL 1 DAY FROM events)\n", 1)


def oracle_sql() -> dict[str, str]:
    out = {name: _PREFIX + body for name, body in BODIES.items()}
    return out | {"pipeline_run_hour": _FIRST_DAY + BODIES["pipeline_backfill"]}
