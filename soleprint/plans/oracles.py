"""The registered queries in DuckDB SQL, written from their definitions."""

BASE = """
WITH ev AS (
  SELECT event_id, event_type,
    make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) AS ts,
    json_extract_string(props, '$.k') AS k, user_id, CAST(floor(value) AS BIGINT) AS v
  FROM events),
click_form AS (
  SELECT event_id,
    CASE WHEN event_type = 'error' THEN '404-' || k ELSE k END AS product_id,
    CAST(user_id AS VARCHAR) AS user_id, v AS view_time, '/' || event_type AS page_url,
    '10.0.0.' || (user_id % 256) AS ip, epoch_us(ts) // 1000 AS payload_ts, ts,
    CAST(k AS INT) % 6 AS "partition",
    ts + to_seconds((event_id * 7919) % 1009) AS arrival, event_type
  FROM ev),
clicks AS (
  SELECT * EXCLUDE (event_type) FROM click_form WHERE event_type IN ('view', 'click', 'error')),
shoes AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS brand, p_name AS name,
    p_size / 10.0::DOUBLE AS rating, printf('%.2f', p_retailprice) AS sale_price
  FROM part),
shoe_updates AS (
  SELECT event_id, k AS id, 'shoe-' || k || '-v' || (v // 50) AS name, ts
  FROM ev WHERE event_type IN ('signup', 'purchase')),
enriched AS (
  SELECT c.*, s.name AS product_name FROM clicks c JOIN shoes s ON c.product_id = s.id),
update_versions AS (
  SELECT id, ts, name FROM shoe_updates
  QUALIFY row_number() OVER (PARTITION BY id, ts ORDER BY event_id DESC) = 1),
asof_enriched AS (
  SELECT c.*, u.name AS product_name
  FROM clicks c ASOF JOIN update_versions u ON c.product_id = u.id AND c.ts >= u.ts),
tumbling AS (
  SELECT product_name, time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
    time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end, count(*) AS views
  FROM enriched GROUP BY ALL),
hops AS (
  SELECT c.*, date_trunc('minute', ts) - to_minutes(h) AS window_start,
    date_trunc('minute', ts) - to_minutes(h) + INTERVAL 10 MINUTE AS window_end
  FROM clicks c CROSS JOIN range(10) AS hop(h)),
hopping AS (
  SELECT product_id, window_start, window_end, count(*) AS views FROM hops GROUP BY ALL),
tumbling_log AS (
  SELECT product_name, time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
    time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end, ts, event_id,
    count(*) OVER (PARTITION BY product_name, time_bucket(INTERVAL 10 MINUTE, ts)
      ORDER BY ts, event_id) AS views
  FROM enriched),
click_time AS (
  SELECT event_id, product_id, ts, "partition", arrival,
    max(ts) OVER (PARTITION BY "partition" ORDER BY arrival, event_id) AS stream_time
  FROM clicks),
enriched_time AS (
  SELECT event_id, product_name, ts, "partition", arrival,
    max(ts) OVER (PARTITION BY "partition" ORDER BY arrival, event_id) AS stream_time
  FROM enriched),
damaged AS (
  SELECT event_id AS "offset", "partition", ts AS "timestamp",
    CASE event_type WHEN 'signup' THEN 'null_value' WHEN 'purchase' THEN 'malformed_json'
      WHEN 'error' THEN CASE WHEN view_time % 2 = 1 THEN 'wrong_type' ELSE 'unknown_field' END
      END AS reason,
    event_type = 'view' AS lacks_ip
  FROM click_form)
"""

_BODIES = {
    "click_source": "SELECT * FROM clicks",
    "shoe_source": "SELECT * FROM shoes",
    "raw_click_scan": """
        SELECT product_id AS record_key, product_id, user_id, view_time, page_url, ip, payload_ts
        FROM clicks""",
    "decode_clicks": """
        SELECT product_id AS record_key, "partition", event_id AS "offset", product_id, user_id,
          view_time, page_url, CASE WHEN event_type = 'click' THEN ip END AS ip, payload_ts, ts
        FROM click_form WHERE event_type IN ('click', 'view')""",
    "decode_shoes": """
        SELECT id AS record_key, CAST(CAST(id AS BIGINT) % 6 AS INT) AS "partition",
          CAST(id AS BIGINT) AS "offset", id, sale_price,
          CASE WHEN id NOT LIKE '%0' THEN brand END AS brand, name, rating,
          make_timestamp(1704067200000000 + CAST(id AS BIGINT) * 1000000) AS ts
        FROM shoes WHERE id NOT LIKE '%5'""",
    "decode_enriched": """
        SELECT product_id AS record_key, product_id, user_id, view_time, page_url, ip,
          payload_ts, product_name, ts, epoch_us(ts) AS "offset"
        FROM enriched""",
    "bad_record_quarantine": """
        SELECT "partition", "offset", "timestamp", reason FROM damaged
        WHERE reason IS NOT NULL""",
    "schema_violations": """
        SELECT "partition", "offset", "timestamp", coalesce(reason, 'missing_field') AS reason
        FROM damaged WHERE reason IS NOT NULL OR lacks_ip""",
    "rekey_clicks": "SELECT product_id AS key, event_id, ts FROM clicks",
    "window_key_string": """
        SELECT '[' || product_name || '@' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || '/'
          || strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') || ']' AS key, views
        FROM tumbling""",
    "peek_metrics": """
        SELECT 'clicks' AS place, count(*) AS n, max(ts) AS max_ts FROM clicks
        UNION ALL SELECT 'shoes', count(*), max(ts) FROM shoe_updates
        UNION ALL SELECT 'views', count(*), max(window_end) FROM tumbling""",
    "shoe_changelog": """
        SELECT event_id, id, name, ts,
          count(*) OVER (PARTITION BY id ORDER BY ts, event_id) AS version
        FROM shoe_updates""",
    "shoe_table": """
        SELECT event_id, id, name, ts FROM shoe_updates
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1""",
    "enriched_clicks": "SELECT * FROM enriched",
    "enriched_clicks_salted": "SELECT * FROM enriched",
    "enriched_clicks_asof": "SELECT * FROM asof_enriched",
    "unmatched_clicks": """
        SELECT product_id, count(*) AS clicks FROM clicks
        WHERE product_id NOT IN (SELECT id FROM shoes) GROUP BY product_id""",
    "views_tumbling": "SELECT * FROM tumbling",
    "views_tumbling_before_join": "SELECT * FROM tumbling",
    "views_hopping": "SELECT * FROM hopping",
    "views_changelog": "SELECT * FROM tumbling_log",
    "views_hopping_changelog": """
        SELECT product_id, window_start, window_end, ts, event_id,
          count(*) OVER (PARTITION BY product_id, window_start ORDER BY ts, event_id) AS views
        FROM hops""",
    "views_compacted": """
        SELECT product_name, window_start, window_end, views FROM tumbling_log
        QUALIFY row_number() OVER (PARTITION BY product_name, window_start
          ORDER BY ts DESC, event_id DESC) = 1""",
    "views_tumbling_late": """
        SELECT product_name, time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
          time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
          count(*) AS views
        FROM enriched_time
        WHERE time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE
          > stream_time - INTERVAL 1 MINUTE
        GROUP BY ALL""",
    "views_hopping_late": """
        SELECT h.product_id, h.window_start, h.window_end, count(*) AS views
        FROM hops h JOIN click_time t ON h.event_id = t.event_id
        WHERE h.window_end > t.stream_time - INTERVAL 1 MINUTE GROUP BY ALL""",
    "late_clicks": """
        SELECT * FROM click_time
        WHERE time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE
          <= stream_time - INTERVAL 1 MINUTE""",
    "live_windows": """
        SELECT * FROM hopping
        WHERE window_start > (SELECT max(ts) FROM clicks) - INTERVAL 30 MINUTE""",
    "running_total": """
        SELECT 'TOTAL' AS key, ts, event_id, count(*) OVER (ORDER BY ts, event_id) AS total
        FROM clicks""",
    "running_total_by_partition": """
        SELECT 'TOTAL' AS key, "partition", ts, event_id,
          count(*) OVER (PARTITION BY "partition" ORDER BY ts, event_id) AS total
        FROM clicks""",
    "running_total_hourly": """
        SELECT 'TOTAL' AS key, date_trunc('hour', ts) AS hour, ts, event_id,
          count(*) OVER (PARTITION BY date_trunc('hour', ts) ORDER BY ts, event_id) AS total
        FROM clicks""",
    "stream_time_ticks": """
        SELECT "partition", time_bucket(INTERVAL 10 SECOND, stream_time) AS tick,
          min(stream_time) AS stream_time
        FROM click_time GROUP BY ALL""",
    "shoe_table_stream": """
        SELECT event_id, id, name, ts FROM shoe_updates
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1""",
    "enriched_clicks_stream": "SELECT * FROM enriched",
    "views_tumbling_stream": "SELECT * FROM tumbling",
    "views_hopping_stream": "SELECT * FROM hopping",
    "running_total_stream": """
        SELECT 'TOTAL' AS key, "partition", ts, event_id,
          count(*) OVER (PARTITION BY "partition" ORDER BY ts, event_id) AS total
        FROM clicks""",
    "click_counter_stateful": """
        SELECT "partition", 'TOTAL' AS key, ts,
          count(*) OVER (PARTITION BY "partition" ORDER BY ts, event_id) AS total
        FROM clicks""",
    "counter_state_table": """
        SELECT "partition", 'TOTAL' AS key, count(*) AS total FROM clicks GROUP BY ALL""",
    "product_views_job_stream": """
        SELECT product_name, time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
          time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
          count(*) AS views
        FROM asof_enriched GROUP BY ALL""",
    "enriched_clicks_state_stream": "SELECT * FROM asof_enriched",
    "product_state_table": """
        SELECT event_id, id, name, ts FROM shoe_updates
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1""",
    "recent_updates_stream": """
        SELECT c.*, u.event_id AS update_id, u.ts AS update_ts, u.name AS product_name
        FROM clicks c JOIN shoe_updates u ON c.product_id = u.id
          AND c.ts BETWEEN u.ts AND u.ts + INTERVAL 10 MINUTE""",
    "shoe_changelog_stream": """
        SELECT event_id, id, name, ts,
          count(*) OVER (PARTITION BY id ORDER BY ts, event_id) AS version,
          lag(name) OVER (PARTITION BY id ORDER BY ts, event_id) AS before
        FROM shoe_updates""",
    "stream_time_ticks_stream": """
        SELECT * FROM (
          SELECT "partition", time_bucket(INTERVAL 10 SECOND, ts) AS tick, count(*) AS rows,
            max(ts) AS stream_time
          FROM clicks GROUP BY "partition", time_bucket(INTERVAL 10 SECOND, ts))
        WHERE tick + INTERVAL 10 SECOND
          <= (SELECT date_trunc('milliseconds', max(ts)) FROM clicks) - INTERVAL 1009 SECOND""",
    "shoe_table_late_stream": """
        SELECT event_id, id, name, ts FROM shoe_updates
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1""",
    "running_total_arrival_stream": """
        SELECT 'TOTAL' AS key, "partition", arrival, event_id,
          count(*) OVER (PARTITION BY "partition" ORDER BY arrival, event_id) AS total
        FROM clicks""",
    "live_windows_stream": """
        SELECT * FROM hopping
        WHERE window_start + INTERVAL 30 MINUTE
          > (SELECT date_trunc('milliseconds', max(ts)) FROM clicks) - INTERVAL 1 MINUTE""",
    "encode_enriched": """
        SELECT hex(encode(product_id)) AS key,
          '0000000003' || hex(encode(CAST(to_json({
            'product_id': product_id, 'user_id': user_id, 'view_time': view_time,
            'page_url': page_url, 'ip': ip, 'ts': payload_ts,
            'product_name': product_name}) AS VARCHAR))) AS value,
          ts AS "timestamp"
        FROM asof_enriched""",
    "encode_views": """
        SELECT hex(encode('[' || product_name || '@'
            || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || '/'
            || strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') || ']')) AS key,
          printf('%016X', views) AS value
        FROM tumbling""",
    "encode_counter": """
        SELECT hex(encode('TOTAL')) AS key,
          printf('%016X', count(*) OVER (PARTITION BY "partition" ORDER BY ts, event_id)) AS value,
          ts AS "timestamp"
        FROM clicks""",
    "encode_retained": """
        SELECT hex(encode(product_id)) || printf('%016X', epoch_us(window_start) // 1000) AS key,
          printf('%016X', views) AS value
        FROM hopping""",
}

_BODIES["raw_click_stream"] = _BODIES["raw_click_scan"]

ORACLES = {name: BASE + body for name, body in _BODIES.items()}
