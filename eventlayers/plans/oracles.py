"""DuckDB SQL that each query must agree with, over the same tables."""

from __future__ import annotations

# The events table as clean web events.
_WEB = """
WITH web AS (
  SELECT event_id, ts AS event_time,
         's' || user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         'u' || user_id AS user_id,
         CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'add_to_cart'
              ELSE 'page_view' END AS event_type,
         'https://shop.example.com' || CASE
           WHEN event_type = 'purchase' THEN '/checkout/success'
           WHEN event_type = 'click' THEN '/product/' || (event_id % 50)
           WHEN event_id % 7 = 0 THEN '/category/components/brakes'
           WHEN event_id % 7 = 1 THEN '/search?q=bike+light'
           WHEN event_id % 7 = 2 THEN '/product/' || (event_id % 50)
           WHEN event_id % 7 = 3 THEN '/category/road-bikes?frame=carbon'
           WHEN event_id % 7 = 4 THEN '/promo/spring-sale'
           ELSE '/home' END AS page_url,
         CASE WHEN event_type IN ('purchase', 'click') THEN
           CASE WHEN event_id % 23 = 0 THEN ' NaN ' WHEN event_id % 29 = 0 THEN ''
                ELSE 'p' || (event_id % 50) END END AS product_id,
         CASE WHEN event_type IN ('purchase', 'click') THEN value END AS price,
         CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS ab_group,
         CASE WHEN event_id % 11 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INT) END AS scroll_depth
  FROM events
), urls AS (
  SELECT *, regexp_replace(regexp_extract(page_url, '^([a-z]+):(//([^/?#]*))?([^?#]*)', 4), ';[^/]*$', '') AS page_path,
         regexp_extract(page_url, '^([a-z]+):(//([^/?#]*))?([^?#]*)', 3) AS page_host
  FROM web
), silver AS (
  SELECT * EXCLUDE (parts), parts[1] AS page_section, parts[2] AS page_category, parts[3] AS page_item
  FROM (SELECT *, list_filter(string_split(page_path, '/'), lambda x: x <> '') AS parts FROM urls)
), page_views AS (
  SELECT event_time, session_id, user_id, page_url, page_category, page_item, scroll_depth, ab_group
  FROM silver WHERE page_url IS NULL OR NOT contains(page_url, '/product/')
), product_events AS (
  SELECT event_time, session_id, user_id, product_id, price, ab_group, page_url
  FROM silver WHERE product_id IS NOT NULL AND lower(trim(product_id)) NOT IN ('', 'nan', 'none', 'null')
)
"""

_PAGES = """
WITH split AS (
  SELECT page_id, regexp_extract(url, '^([a-z]+):(//([^/?#]*))?([^?#]*)', 3) AS page_host,
         regexp_replace(regexp_extract(url, '^([a-z]+):(//([^/?#]*))?([^?#]*)', 4), ';[^/]*$', '') AS page_path
  FROM pages
), parts AS (
  SELECT *, list_filter(string_split(page_path, '/'), lambda x: x <> '') AS p FROM split
), url_parts AS (
  SELECT page_id, page_host, page_path, p[1] AS page_section, p[2] AS page_category, p[3] AS page_item FROM parts
)
"""

# Faults that raw rows and messages are given, by event number.
_BAD_MESSAGE = """CASE WHEN event_id % 101 = 0 THEN 'bad_json' WHEN event_id % 103 = 0 THEN 'unknown_keys'
  WHEN event_id % 107 = 0 THEN 'missing_keys' WHEN event_id % 109 = 0 THEN 'wrong_type'
  WHEN event_id % 113 = 0 OR event_id % 127 = 0 THEN 'bad_json' END"""
_BAD_ROW = """CASE WHEN event_id % 37 = 0 OR event_id % 43 = 0 THEN 'bad_url' WHEN event_id % 41 = 0 THEN 'null_extra'
  WHEN event_id % 31 = 0 THEN 'bad_event_time' END"""
_BASIC_TIME = "CASE WHEN event_id % 5 = 4 THEN date_trunc('second', event_time) ELSE event_time END"

_FILES = """
, files AS (
  SELECT strftime(ts, '%Y/%m/%d/events_%Y%m%d_%H.parquet') AS object_name, count(*) AS rows,
         CAST(sum(length(props)) AS BIGINT) AS bytes, max(ts) AS modified_at, max(event_id) AS last_id
  FROM events GROUP BY 1
)
"""
_TASKS = (
    "WITH x AS (SELECT 1)"
    + _FILES
    + """
, tasks AS (
  SELECT 'ARCHIVE' AS event_type, 'web_events' AS dataset,
         CASE last_id % 5 WHEN 0 THEN 'silver' WHEN 1 THEN 'gold_page_views' WHEN 2 THEN 'lost'
              ELSE 'bronze' END AS layer,
         object_name AS partition_key,
         CASE WHEN last_id % 28 = 13 THEN 'CANCELLED' WHEN last_id % 4 = 0 THEN 'DONE'
              WHEN last_id % 4 = 1 THEN 'PENDING' ELSE 'FAILED' END AS status,
         CASE WHEN last_id % 28 = 13 THEN 0 WHEN last_id % 12 = 6 THEN 2 WHEN last_id % 4 = 0 THEN 1
              WHEN last_id % 4 = 1 THEN 0 ELSE 5 END AS attempts,
         modified_at AS created_at,
         modified_at + to_minutes(CASE WHEN last_id % 28 = 13 THEN 1 WHEN last_id % 4 = 0 THEN 2
                                       WHEN last_id % 4 = 1 THEN 0 ELSE 1 END) AS updated_at,
         last_id * 4 + CASE WHEN last_id % 28 = 13 THEN 1 WHEN last_id % 4 = 0 THEN 2
                            WHEN last_id % 4 = 1 THEN 0 ELSE 1 END AS seq
  FROM files WHERE last_id % 4 <> 3
), shown AS (
  SELECT event_type, dataset, layer, partition_key, status, CAST(attempts AS INT) AS attempts,
         CASE WHEN status = 'FAILED' THEN 'lost' END AS last_error,
         strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
         strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at, seq
  FROM tasks
), open_tasks AS (
  SELECT * FROM shown WHERE status IN ('PENDING', 'FAILED') AND attempts < 5
)
"""
)
_REQUESTS = (
    _TASKS
    + """
, requests AS (
  SELECT strftime(ts, '%Y/%m/%d/events_%Y%m%d_%H.parquet') AS partition_key, event_id AS request_id,
         CASE event_id % 3 WHEN 0 THEN 'DONE' WHEN 1 THEN 'FAILED' ELSE 'IN_PROGRESS' END AS to_status
  FROM events
), first_request AS (
  SELECT partition_key, min(request_id) AS request_id, min_by(to_status, request_id) AS to_status
  FROM requests GROUP BY 1
), running AS (
  SELECT * REPLACE (CASE WHEN status = 'DONE' THEN 'IN_PROGRESS' ELSE status END AS status)
  FROM tasks WHERE layer = 'bronze'
), taken AS (
  SELECT r.*, t.layer, t.attempts, t.status AS was
  FROM first_request r JOIN running t USING (partition_key)
  WHERE CASE WHEN r.to_status = 'IN_PROGRESS' THEN t.status IN ('PENDING', 'FAILED') AND t.attempts < 5
             ELSE t.status = 'IN_PROGRESS' END
)
"""
)
_PLAN = (
    _TASKS
    + """
, plan AS (
  SELECT event_type, dataset, layer, partition_key, attempts,
         CASE WHEN layer <> 'lost' THEN 'layers/' || layer END AS source,
         CASE WHEN layer <> 'lost' THEN 'layers/' || layer || '-archive' END AS archive,
         CASE WHEN layer = 'lost' THEN 'no archive folder is set for web_events/lost' END AS error
  FROM open_tasks
)
"""
)

_RUNS = """
WITH ended AS (
  SELECT *, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS finish FROM events
), history AS (
  SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id,
         CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         {counters},
         CASE WHEN event_type = 'error' THEN left(repeat(event_type, 200), 500) END AS error_message,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
         CASE WHEN event_type <> 'view' THEN strftime(finish, '%Y-%m-%d %H:%M:%S.%f') END AS finished_at,
         CASE WHEN event_type <> 'view' THEN
           CAST(CAST(round((epoch_us(finish) - epoch_us(ts)) / 1000.0) AS BIGINT) / 1000.0 AS DOUBLE)
         END AS duration_seconds
  FROM ended
)
""".format(
    counters=", ".join(
        f"CASE WHEN event_type IN ('view', 'error') THEN 0 ELSE event_id % {7 + i} END AS {name}"
        for i, name in enumerate(
            (
                "bronze_count",
                "silver_count",
                "gold_page_views_count",
                "gold_product_events_count",
                "loaded_page_views_count",
                "loaded_product_events_count",
            )
        )
    )
)

_STAR = """
WITH ids AS (
  SELECT *, md5(user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR)) AS digest FROM events
), records AS (
  SELECT *, CASE WHEN event_id % 17 IN (0, 1) THEN NULL ELSE
           regexp_replace(digest, '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') END AS session_id,
         CASE event_id % 4 WHEN 0 THEN 'firefox' WHEN 1 THEN 'chrome' END AS browser,
         CASE WHEN event_id % 3 = 0 THEN 'mobile' ELSE 'desktop' END AS device
  FROM ids
), valid AS (SELECT * FROM records WHERE session_id IS NOT NULL)
"""

# Rows that reach each layer when the table is sent as messages with faults.
_STREAM = (
    _WEB
    + f"""
, sent AS (SELECT *, {_BAD_MESSAGE} AS bad_message, {_BAD_ROW} AS bad_row FROM silver),
good AS (
  SELECT * REPLACE ({_BASIC_TIME} AS event_time) FROM sent WHERE bad_message IS NULL AND bad_row IS NULL
), good_views AS (
  SELECT event_time, session_id, user_id, page_url, page_category, page_item, scroll_depth, ab_group
  FROM good WHERE NOT contains(page_url, '/product/')
), good_products AS (
  SELECT event_time, session_id, user_id, product_id, price, ab_group, page_url
  FROM good WHERE product_id IS NOT NULL AND lower(trim(product_id)) NOT IN ('', 'nan', 'none', 'null')
)
"""
)
_STREAM_COUNTS = (
    _STREAM
    + """
SELECT * FROM (
  SELECT 'bronze' AS layer, CASE WHEN bad_message IS NULL THEN 'rows' ELSE 'quarantine' END AS route, count(*) AS n
  FROM sent GROUP BY 2
  UNION ALL SELECT 'silver', CASE WHEN bad_row IS NULL THEN 'rows' ELSE 'quarantine' END, count(*)
  FROM sent WHERE bad_message IS NULL GROUP BY 2
  UNION ALL SELECT 'gold', 'gold_page_views', count(*) FROM good_views
  UNION ALL SELECT 'gold', 'gold_product_events', count(*) FROM good_products
  UNION ALL SELECT 'mart_page_views', 'rows', count(*) FROM good_views
  UNION ALL SELECT 'mart_product_events', 'rows', count(*) FROM good_products
)
"""
)

_GAPS = """WITH sent AS (
  SELECT event_type AS topic, CAST(user_id % 3 AS INT) AS partition, event_id AS o FROM events
), gaps AS (
  SELECT * FROM (SELECT *, lag(o) OVER (PARTITION BY topic, partition ORDER BY o) AS before FROM sent) WHERE o - before > 1
)"""

_PAGE_STATS = """SELECT page_url, count(*) AS page_views,
  count(*) FILTER (WHERE scroll_depth IS NULL OR scroll_depth < 30) AS bounces,
  count(*) FILTER (WHERE scroll_depth IS NULL OR scroll_depth < 30) / count(*) AS bounce_rate
FROM page_views GROUP BY page_url"""
_PRODUCT_STATS = """SELECT product_id, count(*) AS events_count,
  CAST(sum(CAST(price AS DECIMAL(10,2))) AS DOUBLE) AS total_revenue
FROM product_events WHERE product_id IS NOT NULL AND product_id <> 'NaN' GROUP BY product_id"""

_SILVER_COLUMNS = f"""{_BASIC_TIME} AS event_time, session_id, user_id, event_type, page_url, page_path,
  page_host, page_section, page_category, page_item, CAST(NULL AS VARCHAR) AS referrer_url, product_id, price,
  ab_group, scroll_depth, CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS VARCHAR) AS user_agent,
  CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS device_type,
  CAST(NULL AS VARCHAR) AS browser_name"""

# Raw time texts, in the five forms the messages carry.
_TRIMMED = "rtrim(rtrim(strftime({0}, '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.')"
_RAW_TIME = f"""CASE WHEN event_id % 31 = 0 THEN 'yesterday'
  WHEN event_id % 5 = 0 THEN {_TRIMMED.format("event_time")} || '+00:00'
  WHEN event_id % 5 = 1 THEN {_TRIMMED.format("event_time")} || 'Z'
  WHEN event_id % 5 = 2 THEN {_TRIMMED.format("event_time")}
  WHEN event_id % 5 = 3 THEN {_TRIMMED.format("event_time + INTERVAL 2 HOUR")} || '+02:00'
  ELSE strftime(event_time, '%Y%m%dT%H%M%S') END"""
_RAW_URL = """CASE WHEN event_id % 37 = 0 THEN replace(page_url, 'https://shop.example.com', 'https://[shop')
  WHEN event_id % 43 = 0 THEN replace(page_url, 'https://shop.example.com', 'https://[shop]')
  ELSE page_url END"""

_TASK_ROWS = """task_rows AS (
      SELECT * FROM (
        SELECT 'bronze' AS layer, count(*) AS rows FROM sent WHERE bad_message IS NULL
        UNION ALL SELECT 'silver', count(*) FROM good
        UNION ALL SELECT 'gold_page_views', count(*) FROM good_views
        UNION ALL SELECT 'gold_product_events', count(*) FROM good_products
      ) WHERE rows > 0)"""

ORACLES: dict[str, str] = {
    "top_landing_pages": f"{_WEB} {_PAGE_STATS} ORDER BY page_views DESC, page_url LIMIT 10",
    "page_stats": f"{_WEB} {_PAGE_STATS}",
    "top_products": f"""{_WEB} SELECT product_id, events_count, coalesce(total_revenue, 0.0) AS total_revenue
        FROM ({_PRODUCT_STATS}) ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 10""",
    "product_stats": f"{_WEB} {_PRODUCT_STATS}",
    "ab_test_summary": f"""{_WEB}, page AS (
          SELECT ab_group, count(*) AS page_views FROM page_views WHERE ab_group IS NOT NULL GROUP BY ab_group
        ), prod AS (
          SELECT ab_group, count(DISTINCT session_id) AS sessions_with_product, count(*) AS product_events
          FROM product_events WHERE ab_group IS NOT NULL GROUP BY ab_group
        )
        SELECT p.ab_group, p.page_views, coalesce(r.sessions_with_product, 0) AS sessions_with_product,
               coalesce(r.product_events, 0) AS product_events
        FROM page p LEFT JOIN prod r ON p.ab_group = r.ab_group ORDER BY p.ab_group""",
    "user_sessions": f"""{_WEB} SELECT session_id, min(event_time) AS first_event_time,
          max(event_time) AS last_event_time, count(*) AS page_views
        FROM page_views WHERE user_id = 'u7' GROUP BY session_id
        ORDER BY first_event_time DESC, session_id LIMIT 20 OFFSET 2""",
    "user_total_sessions": f"""{_WEB} SELECT count(*) AS total_sessions
        FROM (SELECT DISTINCT session_id FROM page_views WHERE user_id = 'u7')""",
    "url_parts": f"{_PAGES} SELECT * FROM url_parts",
    "page_sections": f"{_PAGES} SELECT page_section, count(*) AS pages FROM url_parts GROUP BY page_section",
    "bronze_to_silver": f"{_WEB} SELECT {_SILVER_COLUMNS} FROM silver WHERE {_BAD_ROW} IS NULL",
    "silver_rejects": f"""{_WEB} SELECT event_id, {_RAW_TIME} AS raw_event_time, {_RAW_URL} AS page_url,
        {_BAD_ROW} AS reason FROM web WHERE {_BAD_ROW} IS NOT NULL""",
    "gold_page_views": f"{_WEB} SELECT * FROM page_views",
    "gold_product_events": f"{_WEB} SELECT * FROM product_events",
    "gold_split": f"""{_WEB} SELECT *, 'gold_page_views' AS route FROM page_views
        UNION ALL BY NAME SELECT *, 'gold_product_events' AS route FROM product_events""",
    "gold_split_counts": f"""{_WEB} SELECT 'gold_page_views' AS route, count(*) AS n FROM page_views
        UNION ALL SELECT 'gold_product_events', count(*) FROM product_events""",
    "mart_page_views": f"{_WEB} SELECT * FROM page_views",
    "mart_product_events": f"{_WEB} SELECT * FROM product_events",
    "mart_rejects": f"""{_WEB}, broken AS (
          SELECT * REPLACE (
            CASE WHEN event_id % 10 <> 0 THEN session_id END AS session_id,
            CASE WHEN event_id % 10 = 1 THEN repeat('x', 51) ELSE ab_group END AS ab_group,
            CASE WHEN event_id % 10 = 2 THEN 1e9 ELSE price END AS price)
          FROM silver WHERE product_id IS NOT NULL AND lower(trim(product_id)) NOT IN ('', 'nan', 'none', 'null')
        )
        SELECT CASE WHEN session_id IS NULL THEN 'null:session_id' WHEN length(ab_group) > 50 THEN 'too_long:ab_group'
                    ELSE 'price_overflow' END AS reason, count(*) AS n
        FROM broken WHERE session_id IS NULL OR length(ab_group) > 50 OR price >= 1e8 GROUP BY 1""",
    "decode_messages": f"""{_WEB} SELECT {_RAW_TIME} AS event_time, session_id, user_id, event_type,
          {_RAW_URL} AS page_url, CAST(NULL AS VARCHAR) AS referrer_url, CAST(NULL AS VARCHAR) AS user_agent,
          CAST(NULL AS VARCHAR) AS ip_address, product_id, price, 'sessions_raw' AS topic,
          CAST(event_id % 3 AS INT) AS partition, event_id AS "offset", event_id % 41 = 0 AS extra_is_null,
          CASE WHEN event_id % 41 <> 0 THEN ab_group END AS ab_group,
          CASE WHEN event_id % 41 <> 0 THEN scroll_depth END AS scroll_depth
        FROM web WHERE {_BAD_MESSAGE} IS NULL""",
    "quarantine_reasons": f"""SELECT {_BAD_MESSAGE} AS reason, count(*) AS n FROM events
        WHERE {_BAD_MESSAGE} IS NOT NULL GROUP BY 1""",
    "next_offsets": """SELECT 'sessions_raw' AS topic, CAST(event_id % 3 AS INT) AS partition,
        max(event_id) + 1 AS next_offset FROM events GROUP BY 2""",
    "offset_gaps": f"{_GAPS} SELECT topic, partition, before + 1 AS first_missing, o - 1 AS last_missing FROM gaps",
    "contiguous_offsets": f"""{_GAPS}, lost AS (
          SELECT topic, partition, min(before + 1) AS until, count(*) AS gaps, CAST(sum(o - before - 1) AS BIGINT) AS missing
          FROM gaps GROUP BY ALL
        ), ends AS (SELECT topic, partition, min(o) AS first_offset, max(o) + 1 AS next_offset FROM sent GROUP BY ALL)
        SELECT topic, partition, first_offset, coalesce(until, next_offset) AS contiguous_until, next_offset,
               coalesce(gaps, 0) AS gaps, coalesce(missing, 0) AS missing_offsets
        FROM ends LEFT JOIN lost USING (topic, partition)""",
    "publish_roundtrip": f"""{_WEB} SELECT event_id AS "offset", event_type, page_url, price, ab_group, scroll_depth,
        CAST(NULL AS VARCHAR) AS payment_method, CAST(NULL AS DOUBLE) AS basket_value, session_id AS key FROM web""",
    "flatten": """SELECT event_id, event_type, 0 AS copy FROM events
        UNION ALL SELECT event_id, event_type, 0 FROM events
        UNION ALL SELECT event_id, upper(event_type), 1 FROM events""",
    "current_tasks": f"{_TASKS} SELECT * FROM shown",
    "task_history": """SELECT CAST(user_id AS VARCHAR) AS partition_key,
          CASE max_by(event_type, event_id) WHEN 'purchase' THEN 'DONE' WHEN 'error' THEN 'FAILED'
               WHEN 'click' THEN 'IN_PROGRESS' ELSE 'PENDING' END AS status,
          CAST(max(event_id) % 6 AS INT) AS attempts, max(event_id) AS seq
        FROM events GROUP BY user_id""",
    "existing_keys": f"""{_TASKS} SELECT partition_key FROM tasks JOIN files ON object_name = partition_key
        WHERE layer = 'bronze' AND rows % 2 = 0""",
    "unprocessed_files": f"""{_TASKS} SELECT object_name, rows FROM files
        WHERE object_name NOT IN (SELECT partition_key FROM tasks WHERE layer = 'bronze')""",
    "file_progress": f"""{_TASKS} SELECT count(*) AS files, count(layer) AS skipped_files,
          count(*) - count(layer) AS new_files
        FROM files LEFT JOIN tasks ON object_name = partition_key AND layer = 'bronze'""",
    "pending_tasks": f"""{_TASKS} SELECT * FROM open_tasks WHERE layer = 'bronze'
        ORDER BY updated_at, partition_key LIMIT 50""",
    "latest_tasks": f"{_TASKS} SELECT * FROM shown ORDER BY updated_at DESC, seq DESC LIMIT 5",
    "task_status_counts": f"""{_TASKS}, known AS (
          SELECT unnest(['PENDING', 'IN_PROGRESS', 'DONE', 'FAILED']) AS status
        ), counts AS (SELECT status, count(*) AS n FROM tasks GROUP BY status)
        SELECT status, coalesce(n, 0) AS tasks_count FROM counts FULL OUTER JOIN known USING (status)
        UNION ALL SELECT 'TOTAL', count(*) FROM tasks""",
    "enqueue_tasks": f"""{_TASKS} SELECT 'ARCHIVE' AS event_type, 'web_events' AS dataset, 'bronze' AS layer,
          object_name AS partition_key, 'PENDING' AS status, 0 AS attempts, 1000000000000 AS seq
        FROM files WHERE object_name NOT IN (SELECT partition_key FROM tasks WHERE layer = 'bronze')""",
    "apply_transitions": f"""{_REQUESTS} SELECT layer, partition_key, to_status AS status,
          CAST(attempts + CASE WHEN to_status = 'IN_PROGRESS' THEN 1 ELSE 0 END AS INT) AS attempts,
          CASE WHEN to_status = 'FAILED' THEN left(repeat('lost ', 200), 500)
               WHEN was = 'FAILED' THEN 'lost' END AS last_error, 1000000000000 AS seq
        FROM taken""",
    "refused_transitions": f"""{_REQUESTS} SELECT * FROM requests
        WHERE request_id NOT IN (SELECT request_id FROM taken)""",
    "archive_plan": f"{_PLAN} SELECT * FROM plan",
    "archive_report": f"""{_PLAN}, outcomes AS (
          SELECT CASE WHEN error IS NOT NULL THEN 'failed' WHEN rows % 3 = 0 THEN 'archived'
                      WHEN rows % 2 = 0 THEN 'waiting' ELSE 'skipped' END AS outcome
          FROM plan JOIN files ON object_name = partition_key
        )
        SELECT count(*) FILTER (WHERE outcome <> 'waiting') AS taken,
               count(*) FILTER (WHERE outcome = 'archived') AS archived,
               count(*) FILTER (WHERE outcome = 'failed') AS failed,
               count(*) FILTER (WHERE outcome = 'skipped') AS skipped FROM outcomes""",
    "retention_plan": f"""{_TASKS} SELECT 'bronze' AS layer, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows,
          CAST(sum(bytes) AS BIGINT) AS bytes, min(modified_at) AS oldest
        FROM files WHERE modified_at < TIMESTAMP '2024-01-23' GROUP BY 1""",
    "watermark_upsert": """SELECT 'web_events' AS dataset, event_type AS layer,
          max(CASE WHEN event_type <> 'error' THEN ts END) AS last_processed_ts,
          CAST(trunc(max_by(value, event_id) FILTER (WHERE event_id % 4 = 0)) AS BIGINT) AS last_processed_id,
          max(ts) AS updated_at
        FROM events GROUP BY event_type""",
    "layer_watermark": f"""{_WEB} SELECT 'web_events' AS dataset, 'bronze_to_silver' AS layer,
          max(event_time) AS last_processed_ts FROM silver""",
    "run_history": f"""{_RUNS} SELECT *, gold_page_views_count + gold_product_events_count AS gold_count,
          loaded_page_views_count + loaded_product_events_count AS loaded_count FROM history""",
    "latest_runs": f"{_RUNS} SELECT * FROM history ORDER BY started_at DESC, run_id DESC LIMIT 5",
    "dim_users": f"{_STAR} SELECT DISTINCT user_id FROM valid WHERE user_id % 3 <> 0",
    "dim_sessions": f"""{_STAR}, first_ids AS (
          SELECT session_id, min(event_id) AS event_id FROM valid GROUP BY session_id
        )
        SELECT session_id, user_id, browser, device FROM valid JOIN first_ids USING (session_id, event_id)
        WHERE user_id % 7 <> 0""",
    "fact_events": f"""{_STAR} SELECT event_id, session_id, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp,
          CASE WHEN event_id % 13 <> 0 THEN event_type ELSE '' END AS type FROM valid""",
    "skipped_sessions": """SELECT CASE WHEN event_id % 17 = 0 THEN 'session-' || (event_id % 5) END AS session_id,
          count(*) AS records FROM events WHERE event_id % 17 IN (0, 1) GROUP BY 1""",
    "skipped_count": "SELECT count(*) AS skipped FROM events WHERE event_id % 17 IN (0, 1)",
    "layer_stats": f"""{_WEB}, hours AS (
          SELECT 'bronze' AS layer, ts AS t FROM events UNION ALL SELECT 'silver', event_time FROM silver
          UNION ALL SELECT 'gold_page_views', event_time FROM page_views
          UNION ALL SELECT 'gold_product_events', event_time FROM product_events
        ), per_layer AS (
          SELECT layer, count(DISTINCT date_trunc('hour', t)) AS files, count(*) AS rows FROM hours GROUP BY layer
        )
        SELECT * FROM per_layer UNION ALL
        SELECT 'gold', CAST(sum(files) AS BIGINT), CAST(sum(rows) AS BIGINT) FROM per_layer WHERE layer LIKE 'gold_%'""",
    "layer_files": f"""{_WEB} SELECT strftime(event_time, '%Y/%m/%d') AS folder, count(*) AS rows,
          count(DISTINCT event_id) AS keys, count(*) AS named FROM silver GROUP BY 1""",
    "stream_dedupe": """SELECT CAST(event_id % 3 AS INTEGER) AS partition, count(*) AS rows,
          count(DISTINCT event_id) AS offsets FROM events GROUP BY 1""",
    "stream_dedupe_runs": """SELECT CAST(event_id % 3 AS INTEGER) AS partition, count(*) AS rows,
          count(DISTINCT event_id) AS offsets FROM events GROUP BY 1""",
    "stream_rollups": f"""{_STREAM}, prod AS (
          SELECT ab_group, count(DISTINCT session_id) AS sessions, count(*) AS n
          FROM good_products WHERE ab_group IS NOT NULL GROUP BY ab_group
        )
        SELECT 'page' AS report, page_url AS key, count(*) AS rows,
               count(*) FILTER (WHERE scroll_depth IS NULL OR scroll_depth < 30) AS other, CAST(NULL AS DOUBLE) AS amount
        FROM good_views GROUP BY page_url
        UNION ALL SELECT 'product', product_id, count(*), NULL, CAST(sum(CAST(price AS DECIMAL(10, 2))) AS DOUBLE)
        FROM good_products WHERE product_id <> 'NaN' GROUP BY product_id
        UNION ALL SELECT 'group', v.ab_group, v.n, coalesce(p.sessions, 0), CAST(coalesce(p.n, 0) AS DOUBLE)
        FROM (SELECT ab_group, count(*) AS n FROM good_views WHERE ab_group IS NOT NULL GROUP BY ab_group) v
        LEFT JOIN prod p ON v.ab_group = p.ab_group
        UNION ALL SELECT 'user', user_id, count(*), count(DISTINCT session_id), NULL FROM good_views GROUP BY user_id""",
    "stream_layer_counts": _STREAM_COUNTS,
    "stream_replay_no_duplicates": _STREAM_COUNTS,
    "stream_mart_page_views": f"{_STREAM} SELECT * FROM good_views",
    "stream_mart_product_events": f"{_STREAM} SELECT * FROM good_products",
    "stream_user_sessions": f"""{_STREAM} SELECT session_id, min(event_time) AS first_event_time,
          max(event_time) AS last_event_time, count(*) AS page_views
        FROM good_views WHERE user_id = 'u7' GROUP BY session_id
        ORDER BY first_event_time DESC, session_id LIMIT 20""",
    "stream_replay_after_archive": _STREAM_COUNTS,
    "lake_compacted": _STREAM_COUNTS,
    "stream_tasks": f"""{_STREAM}, {_TASK_ROWS} SELECT layer, rows FROM task_rows""",
    "stream_run_full": f"""{_STREAM}, n AS (
          SELECT (SELECT count(*) FROM sent WHERE bad_message IS NULL) AS bronze, (SELECT count(*) FROM good) AS silver,
                 (SELECT count(*) FROM good_views) AS views, (SELECT count(*) FROM good_products) AS products
        )
        SELECT run, 'SUCCESS' AS status, bronze * k AS bronze_count, silver * k AS silver_count,
               views * k AS gold_page_views_count, products * k AS gold_product_events_count,
               views * k AS loaded_page_views_count, products * k AS loaded_product_events_count
        FROM n, (VALUES (1, 1), (2, 0)) AS runs(run, k)""",
    "archive_settled": f"""{_STREAM}, {_TASK_ROWS}
        SELECT layer, rows AS done_rows, CAST(0 AS BIGINT) AS active_rows, rows AS archived_rows FROM task_rows""",
}
