"""The same results as plain SQL over the same tables."""

from __future__ import annotations

import re

from .views import VIEWS

_AGGS = """count(*) AS reading_cnt, count(value) AS value_cnt, round(sum(value), 4) AS value_sum,
       max(value) AS value_max, min(value) AS value_min"""


def _rollup(grain: str, source: str = "readings", keys: str = "device_id, metric") -> str:
    return f"""SELECT date_trunc('{grain}', event_time) AS event_{grain}, {keys}, {_AGGS}
        FROM {source} GROUP BY ALL"""


# Half-open January range that several reports use.
_RANGE = "event_time >= TIMESTAMP '2024-01-03' AND event_time < TIMESTAMP '2024-01-28'"
_GOOD = "SELECT event_time, device_id, metric, value FROM messages WHERE reason IS NULL"
_REJECTS = "SELECT reason, count(*) AS n FROM messages WHERE reason IS NOT NULL GROUP BY reason"


def _days_replaced(condition: str, kept: str = "TRUE") -> str:
    return f"""SELECT event_time, device_id, metric,
               CASE WHEN {condition} THEN value ELSE value * 2 END AS value
        FROM readings WHERE {kept}"""


_IS_DAY = "CAST(event_time AS DATE) = DATE '2024-01-05'"
_IN_BACKFILL = "event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20'"

_TIES = """
    WITH numbered AS (
      SELECT *, row_number() OVER (ORDER BY event_time) AS rn, count(*) OVER () AS n FROM line_readings
    ),
    size AS (SELECT CAST(ceil(max(n) / 3.0) AS BIGINT) AS third FROM numbered),
    c1 AS (SELECT max(event_time) AS t FROM numbered, size WHERE rn <= third),
    p1 AS (SELECT max(rn) AS p FROM numbered, c1 WHERE event_time <= t),
    c2 AS (SELECT max(event_time) AS t FROM numbered, size, p1 WHERE rn <= p + third),
    p2 AS (SELECT max(rn) AS p FROM numbered, c2 WHERE event_time <= t),
    c3 AS (SELECT max(event_time) AS t FROM numbered, size, p2 WHERE rn <= p + third)
    SELECT CAST(CASE WHEN event_time <= c1.t THEN 1 WHEN event_time <= c2.t THEN 2
                     WHEN event_time <= c3.t THEN 3 ELSE 4 END AS INTEGER) AS batch,
           event_time, device_id, metric, value
    FROM line_readings, c1, c2, c3"""

_DQ = """
        WITH stats AS (
          SELECT count(*) FILTER (event_time >= TIMESTAMP '2024-01-30') AS n,
                 count(*) FILTER (event_time >= TIMESTAMP '2024-01-30' AND value IS NULL) AS nulls,
                 date_sub('minute', max(event_time), TIMESTAMP '2024-01-30 23:30:00') AS lag
          FROM readings)
        SELECT 'row_count' AS gate, CAST(n AS DOUBLE) AS observed, 1.0::DOUBLE AS max_or_min, n >= 1 AS passed
        FROM stats
        UNION ALL
        SELECT 'null_ratio', round(nulls / n, 6), 0.05::DOUBLE, coalesce(nulls / n <= 0.05, FALSE) FROM stats
        UNION ALL
        SELECT 'freshness', CAST(lag AS DOUBLE), 60.0::DOUBLE, coalesce(lag <= 60, FALSE) FROM stats"""

_SITE_TOPN = """
        WITH per_device AS (
          SELECT d.site_code, r.device_id, sum(value) AS value_sum
          FROM readings r JOIN device d ON r.device_id = d.device_id
          WHERE metric = 'purchase' GROUP BY ALL)
        SELECT site_code, CAST(rn AS INTEGER) AS rank, device_id, round(value_sum, 4) AS value_sum
        FROM (SELECT *, row_number() OVER (PARTITION BY site_code
                ORDER BY value_sum DESC NULLS LAST, device_id) AS rn FROM per_device)
        WHERE rn <= 3"""

_TOPN = f"""
        SELECT device_id, round(total, 4) AS value_sum
        FROM (SELECT device_id, sum(value) AS total FROM readings
              WHERE metric = 'view' AND {_RANGE}
              GROUP BY device_id ORDER BY total DESC NULLS LAST, device_id LIMIT 10)"""

_BODIES = {
    "increment_after_watermark": """
        WITH pending AS (SELECT * FROM readings WHERE event_time > TIMESTAMP '2024-01-11'),
        batch AS (SELECT event_time FROM pending ORDER BY event_time LIMIT 200000)
        SELECT * FROM pending WHERE event_time <= (SELECT max(event_time) FROM batch)""",
    "increment_ties": _TIES,
    "increment_resume_no_dup": "SELECT * FROM readings",
    "watermark_advance": """
        SELECT 'readings' AS job_key, strftime(max(event_time), '%Y-%m-%d %H:%M:%S.%f') AS watermark
        FROM readings
        UNION ALL
        SELECT 'other.job', strftime(max(event_time), '%Y-%m-%d %H:%M:%S.%f')
        FROM readings WHERE event_time < TIMESTAMP '2024-01-05'""",
    "day_slice": f"SELECT * FROM readings WHERE {_IS_DAY}",
    "json_conform": _GOOD,
    "json_rejects": _REJECTS,
    "json_batch_lines": _GOOD,
    "json_batch_array": _GOOD,
    "json_load": _GOOD,
    "json_resend_after_compact": f"""
        {_GOOD}
        UNION ALL
        SELECT event_time, device_id, metric, value FROM readings WHERE event_time < TIMESTAMP '2024-01-02'""",
    "load_resend_fails": "SELECT * FROM readings",
    "backfill_replaces_day": _days_replaced(_IS_DAY),
    "backfill_empty_day": f"SELECT * FROM readings WHERE NOT ({_IS_DAY})",
    "backfill_range": _days_replaced(
        _IN_BACKFILL, f"NOT ({_IN_BACKFILL} AND event_time > TIMESTAMP '2024-01-18 12:00:00')"
    ),
    "day_swap": _days_replaced(_IS_DAY),
    "retention": "SELECT * FROM readings WHERE event_time >= TIMESTAMP '2024-01-12'",
    "rollup_retention": f"""
        SELECT date_trunc('minute', event_time) AS event_minute, device_id, metric, {_AGGS}
        FROM readings WHERE event_time >= TIMESTAMP '2024-01-17' GROUP BY ALL""",
    "device_lookup": "SELECT * FROM readings WHERE device_id = 7",
    "stream_history": "SELECT count(*) AS n, 0::BIGINT AS over_limit, 0::BIGINT AS missing, true AS two_runs FROM messages WHERE reason IS NULL",
    "compact_days": "SELECT * FROM readings",
    "device_history": f"SELECT * FROM readings WHERE device_id = 7 AND {_RANGE}",
    "rollup_minute": _rollup("minute"),
    "rollup_hourly": _rollup("hour"),
    "rollup_daily": _rollup("day"),
    "rollup_merge_partials": _rollup("hour"),
    "rollup_avg": f"""
        SELECT date_trunc('hour', event_time) AS event_hour, device_id, metric, {_AGGS},
               round(sum(value) / count(value), 10) AS value_avg,
               round(sum(value) / count(*), 10) AS avg_per_reading
        FROM readings GROUP BY ALL""",
    "mv_hourly_refresh": f"""
        SELECT date_trunc('hour', event_time) AS event_hour, device_id, metric,
               count(*) AS reading_cnt, round(sum(v), 4) AS value_sum, max(v) AS value_max
        FROM (SELECT *, CASE WHEN {_IS_DAY} THEN value * 2 ELSE value END AS v FROM readings)
        GROUP BY ALL""",
    "rollup_routed_daily": f"""
        SELECT date_trunc('day', event_time) AS event_day, metric, {_AGGS},
               round(sum(value) / count(value), 10) AS value_avg
        FROM readings GROUP BY ALL""",
    "rollup_routed_stale": f"""
        SELECT date_trunc('day', event_time) AS event_day, metric, count(*) AS reading_cnt, round(sum(v), 4) AS value_sum
        FROM (SELECT *, CASE WHEN {_IS_DAY} THEN value * 2 ELSE value END AS v FROM readings)
        GROUP BY ALL""",
    "rollup_routed_filtered": f"""
        SELECT date_trunc('day', event_time) AS event_day, device_id, count(*) AS reading_cnt,
               round(sum(value), 4) AS value_sum
        FROM readings WHERE metric = 'click' AND device_id < 40 AND {_RANGE} GROUP BY ALL""",
    "rollup_routed_split": f"""
        SELECT metric, {_AGGS}, round(sum(value) / count(value), 10) AS value_avg
        FROM readings
        WHERE event_time >= TIMESTAMP '2024-01-03 10:30:00' AND event_time < TIMESTAMP '2024-01-28 09:17:00'
        GROUP BY ALL""",
    "rollup_routed_slice": """
        SELECT date_trunc('hour', event_time) AS event_hour, device_id, count(*) AS reading_cnt,
               round(sum(value), 4) AS value_sum
        FROM readings
        WHERE event_time >= TIMESTAMP '2024-01-03 10:30:00' AND event_time < TIMESTAMP '2024-01-28 09:17:00'
        GROUP BY ALL""",
    "dim_upsert_delete": """
        SELECT device_id, site_code, updated_at, seq
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY updated_at DESC, seq DESC) AS rn
              FROM device_changes)
        WHERE rn = 1 AND op = 0""",
    "dim_upsert_rejects": """
        WITH told AS (
          SELECT *, CASE WHEN seq % 50 = 0 THEN 'device_id missing' WHEN seq % 50 IN (1, 2) THEN '__op invalid'
                         WHEN seq % 50 = 3 THEN 'site_code too long' END AS reason
          FROM device_changes)
        SELECT reason, count(*) AS n FROM told WHERE reason IS NOT NULL GROUP BY reason
        UNION ALL
        SELECT 'served', count(*)
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY updated_at DESC, seq DESC) AS rn
              FROM told WHERE reason IS NULL)
        WHERE rn = 1 AND op = 0""",
    "dim_stream_upsert": """
        SELECT device_id, site_code, updated_at, seq
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY updated_at DESC, seq DESC) AS rn
              FROM device_changes)
        WHERE rn = 1 AND op = 0
        UNION ALL SELECT count(*), 'rejects', NULL, NULL FROM device_changes WHERE seq % 50 = 0""",
    "load_gated": """
        SELECT event_time, device_id, metric, coalesce(value, 0) AS value FROM readings
        WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-01-05'""",
    "ingested_at_filled": """
        SELECT CASE WHEN event_time < TIMESTAMP '2024-01-10' THEN 'early' ELSE 'late' END AS load_label, count(*) AS n,
               0::BIGINT AS missing, count(*) FILTER (event_time >= TIMESTAMP '2024-01-10') AS as_given
        FROM readings WHERE event_time >= TIMESTAMP '2024-01-01' GROUP BY ALL""",
    "fact_dim_hot": """
        SELECT event_time, r.hot AS device_id, metric, value, d.site_code
        FROM (SELECT *, CASE WHEN minute(event_time) % 3 = 0 THEN 1 ELSE device_id END AS hot FROM readings) r
        JOIN device d ON r.hot = d.device_id""",
    "fact_dim_join": """
        SELECT r.*, d.device_name, d.site_code, d.is_active
        FROM readings r JOIN device d ON r.device_id = d.device_id""",
    "fact_dim_bucketed": """
        SELECT r.*, d.device_name, d.site_code, d.is_active
        FROM readings r JOIN device d ON r.device_id = d.device_id""",
    "denormalized_rollup": f"""
        SELECT date_trunc('minute', event_time) AS event_minute, r.device_id, metric, site_code, {_AGGS}
        FROM readings r LEFT JOIN device d ON r.device_id = d.device_id AND d.is_active
        GROUP BY ALL""",
    "denormalized_readings": """
        SELECT r.*, site_code
        FROM readings r LEFT JOIN device d ON r.device_id = d.device_id AND d.is_active""",
    "site_metric_groupby": f"""
        SELECT site_code, metric, {_AGGS}
        FROM readings r JOIN device d ON r.device_id = d.device_id GROUP BY ALL""",
    "region_metric_groupby": f"""
        SELECT region, is_active, metric, {_AGGS}
        FROM readings r JOIN device d ON r.device_id = d.device_id
        JOIN site s ON d.site_code = s.site_code GROUP BY ALL""",
    "site_topn": _SITE_TOPN,
    "site_topn_stored": _SITE_TOPN,
    "site_groupby_routed": f"""
        SELECT site_code, metric, count(*) AS reading_cnt, round(sum(value), 4) AS value_sum,
               max(value) AS value_max
        FROM readings r LEFT JOIN device d ON r.device_id = d.device_id
        WHERE {_RANGE} GROUP BY ALL""",
    "site_groupby_off_border": f"""
        SELECT site_code, metric, count(*) AS reading_cnt, round(sum(value), 4) AS value_sum,
               max(value) AS value_max
        FROM readings r LEFT JOIN device d ON r.device_id = d.device_id
        WHERE {_RANGE} AND event_time >= TIMESTAMP '2024-01-03 10:30:00' GROUP BY ALL""",
    "topn_devices": _TOPN,
    "topn_tiny_values": _TOPN,
    "timeseries_hourly": f"""
        SELECT date_trunc('hour', event_time) AS event_hour, {_AGGS}
        FROM readings WHERE metric = 'click' AND {_RANGE} GROUP BY ALL""",
    "groupby_dims": f"SELECT device_id, metric, {_AGGS} FROM readings WHERE {_RANGE} GROUP BY ALL",
    "dq_report": _DQ,
    "dq_table_report": _DQ,
    "published_after_gates": """
        SELECT date_trunc('day', event_time) AS event_day, device_id, count(*) AS reading_cnt,
               max(coalesce(value, CASE WHEN minute(event_time) % 2 = 0 THEN 0.0 END)) AS value_max
        FROM readings GROUP BY ALL""",
    "blocked_by_gates": _rollup("hour").replace("FROM readings", "FROM readings WHERE event_time < TIMESTAMP '2024-01-20'"),
    "stream_raw_readings": _GOOD,
    "stream_replay_after_compact": _GOOD,
    "stream_budget_raised": _GOOD,
    "stream_rollup_minute": f"""
        SELECT date_trunc('minute', event_time) AS event_minute, r.device_id, metric, site_code, {_AGGS}
        FROM messages r LEFT JOIN device d ON r.device_id = d.device_id AND d.is_active
        WHERE reason IS NULL GROUP BY ALL""",
    "stream_rollup_versioned": f"""
        WITH numbered AS (
            SELECT event_id % 3 AS part, CASE WHEN k IN (0, 2, 3, 5, 6, 7) THEN NULL ELSE ts END AS event_time, user_id AS device_id, event_type AS metric,
                   CASE WHEN k IN (1, 4) THEN NULL ELSE value END AS value
            FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
        placed AS (
            SELECT r.*, CASE WHEN r.device_id % (part + 1) = 0 THEN d.site_code || '-' || part ELSE d.site_code END AS site_code
            FROM numbered r LEFT JOIN device d ON r.device_id = d.device_id WHERE event_time IS NOT NULL)
        SELECT date_trunc('minute', event_time) AS event_minute, device_id, metric, site_code, {_AGGS}
        FROM placed GROUP BY ALL""",
    "stream_rollup_windowed": f"""
        WITH good AS (
          SELECT r.*, site_code FROM messages r LEFT JOIN device d ON r.device_id = d.device_id AND d.is_active
          WHERE reason IS NULL)
        SELECT date_trunc('minute', event_time) AS event_minute, device_id, metric, site_code, {_AGGS}
        FROM good
        WHERE date_trunc('minute', event_time) + INTERVAL 1 MINUTE
              <= (SELECT max(event_time) FROM good) - INTERVAL 10 MINUTE
        GROUP BY ALL""",
    "stream_quarantine": _REJECTS,
}


def _with_views(body: str) -> str:
    """The body with the views it names put before it."""
    names = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in names)
    body = body.strip()
    if body.startswith("WITH"):
        return f"WITH {ctes}, {body[len('WITH'):].strip()}"
    return f"WITH {ctes} {body}"


ORACLES = {name: _with_views(body) for name, body in _BODIES.items()}
