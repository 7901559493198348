"""Independent SQL (DuckDB dialect) for every check that has one.

The oracle never reads JSON: it recomputes the micro-batch figures straight
from ``events`` and applies each metric's definition in plain SQL, so a
mismatch points at the Spark operator chain (JSON packing, parsing, frames,
joins), not at shared code.  Rounded metrics use the same
DECIMAL(18,6)-then-round rule as ``round_half_up``.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------------------
# Fixed values shared with the Spark fixture (sources/progress_log.py).
# ---------------------------------------------------------------------------
EPOCH_US = 1704067200000000
HOUR_US = 3600000000
AS_OF_END = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_OVERVIEW = "TIMESTAMP '2024-01-10 21:09:00'"
SLA_MS = 1800000


def r(expr: str, n: int) -> str:
    """round_half_up"""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18,6)), {n}) AS DOUBLE)"


BN = f"CAST((epoch_us(ts) - {EPOCH_US}) // {HOUR_US} AS BIGINT)"

MB = f"""mb AS (
  SELECT event_type, bn AS batch_id, n, cents, nu, small, late, tmin, tmax,
         TIMESTAMP '2024-01-01 00:00:00' + (bn + 1) * INTERVAL 1 HOUR AS batch_ts
  FROM (SELECT event_type, {BN} AS bn, COUNT(*) AS n,
               CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents,
               COUNT(DISTINCT user_id) AS nu,
               CAST(SUM(CASE WHEN value < 1 THEN 1 ELSE 0 END) AS BIGINT) AS small,
               CAST(SUM(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS late,
               MIN(date_trunc('millisecond', ts)) AS tmin,
               MAX(date_trunc('millisecond', ts)) AS tmax
        FROM events GROUP BY 1, 2) t)"""

PROG = """prog AS (
  SELECT 'q-' || event_type AS query_id, 'stream_' || event_type AS query_name, event_type, batch_id,
         batch_ts AS timestamp, batch_ts AS trigger_ts,
         cents AS batch_duration_ms, n AS num_input_rows,
         n / 3600e0 AS input_rows_per_second, cents / 18000000e0 AS processed_rows_per_second,
         CASE WHEN n % 6 = 0 THEN NULL ELSE tmin END AS event_time_min,
         CASE WHEN n % 6 = 0 THEN NULL ELSE tmax END AS event_time_max,
         CASE WHEN n % 6 = 0 THEN NULL ELSE tmax - INTERVAL 30 SECOND END AS watermark,
         CAST(CASE WHEN event_type = 'view' THEN 0 ELSE cents * 1024 + n * 4096 END AS BIGINT) AS state_memory_bytes,
         CAST(CASE WHEN event_type = 'view' THEN 0 ELSE n + CASE WHEN n % 5 = 0 THEN 0 ELSE nu END END AS BIGINT) AS state_rows_total,
         CASE WHEN event_type = 'signup' THEN NULL ELSE (n - nu) / CAST(n AS DOUBLE) END AS duplicate_rate,
         CASE WHEN event_type = 'signup' THEN NULL ELSE small END AS dropped_record_count,
         CASE WHEN event_type = 'signup' THEN NULL ELSE late / CAST(n AS DOUBLE) END AS late_record_percentage,
         CASE WHEN event_type = 'signup' THEN NULL ELSE small / CAST(n AS DOUBLE) END AS value_null_rate,
         event_type <> 'signup' AND batch_id % 24 = 5 AS schema_change_detected,
         event_type <> 'signup' AS has_quality,
         'prod' AS environment, 'ws-0001' AS workspace_id,
         sha256(concat_ws('|', 'progress', 'q-' || event_type, CAST(batch_id AS VARCHAR))) AS id
  FROM mb)"""

ERRS = f"""errs AS (
  SELECT 'q-' || (['click', 'error', 'purchase', 'signup', 'view'])[user_id % 5 + 1] AS query_id,
         'stream_' || (['click', 'error', 'purchase', 'signup', 'view'])[user_id % 5 + 1] AS query_name,
         {BN} AS batch_id,
         date_trunc('millisecond', ts) AS timestamp,
         (['StreamingQueryException', 'SparkException', 'IOException'])[event_id % 3 + 1] AS exception_type,
         'error event ' || CAST(event_id AS VARCHAR) AS exception_message,
         CASE WHEN event_id % 2 = 0 THEN 'QUERY_FAILED' ELSE 'RETRYABLE' END AS termination_reason,
         CASE WHEN event_id % 2 = 0 THEN 'at batch ' || CAST({BN} AS VARCHAR) END AS stack_trace,
         CASE WHEN event_id % 2 = 0 THEN 'ERROR' ELSE 'WARN' END AS level,
         'prod' AS environment, 'ws-0001' AS workspace_id, event_id,
         sha256(concat_ws('|', 'error', CAST(event_id AS VARCHAR))) AS id
  FROM events WHERE event_type = 'error'),
errs_rc AS (
  SELECT *, CAST(SUM(CASE WHEN termination_reason = 'RETRYABLE' THEN 0 ELSE 1 END)
                OVER (PARTITION BY query_id ORDER BY timestamp, exception_message ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS restart_count
  FROM errs)"""

SLA = f"""sla AS (
  SELECT query_id, query_name, batch_id, timestamp, event_time_min, event_time_max, timestamp AS processing_time,
         epoch_ms(timestamp) - epoch_ms(event_time_max) AS latency_ms,
         COALESCE(epoch_ms(timestamp) - epoch_ms(event_time_max) > {SLA_MS}, false) AS sla_breach_flag,
         CAST({SLA_MS} AS BIGINT) AS sla_threshold_ms, environment, workspace_id
  FROM prog)"""

INFRA = """samples AS (
  SELECT 'c-' || CAST(user_id % 8 AS VARCHAR) AS cluster_id, ts AS timestamp, event_id AS sample_id,
         LEAST(value, 100.0) AS cpu_usage_percent,
         CAST((event_id * 37) % 101 AS DOUBLE) AS memory_usage_percent,
         CAST((event_id * 7919) % 10 + 1 AS INTEGER) AS executor_count,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 100 END AS dbu_consumption,
         'prod' AS environment
  FROM events),
infra AS (
  SELECT *, CASE WHEN prev IS NULL THEN NULL WHEN executor_count > prev THEN 'SCALE_UP'
                 WHEN executor_count < prev THEN 'SCALE_DOWN' END AS autoscaling_event
  FROM (SELECT *, LAG(executor_count) OVER (PARTITION BY cluster_id ORDER BY timestamp, sample_id) AS prev FROM samples) s)"""

CTE = {"mb": MB, "prog": PROG, "errs": ERRS, "sla": SLA, "infra": INFRA}
NEEDS = {"prog": ["mb"], "sla": ["mb", "prog"], "errs": [], "infra": [], "mb": []}


def with_(parts: list[str], body: str) -> str:
    seen: list[str] = []
    for p in parts:
        for d in NEEDS[p] + [p]:
            if d not in seen:
                seen.append(d)
    b = body.lstrip("\n")
    return "WITH " + ",\n".join(CTE[p] for p in seen) + ("" if b.startswith(",") else "\n") + b


def lookback_days(as_of: str, days: int | None, ts: str = "timestamp") -> str:
    cond = f"{ts} <= {as_of}"
    if days is not None:
        cond += f" AND CAST({ts} AS DATE) >= CAST({as_of} AS DATE) - INTERVAL {days} DAY"
    return cond


def lookback_minutes(as_of: str, minutes: int, ts: str = "timestamp") -> str:
    return f"{ts} >= {as_of} - INTERVAL {minutes} MINUTE AND {ts} <= {as_of}"


WEEK_END = lookback_days(AS_OF_END, 7)
MONTH_END = lookback_days(AS_OF_END, 30)
ALL_OVERVIEW = lookback_days(AS_OF_OVERVIEW, None)
DAY, WEEK, MONTH = 1440, 10080, 43200

# ---------------------------------------------------------------- silver ----

ORACLE["bronze_events"] = with_(["prog", "errs"], """
SELECT id, timestamp, 'METRICS' AS level, 'stream_progress' AS event_type, 'STABLE' AS maturity_level,
       'Completed streaming update for ''' || query_name || ''' batch ' || CAST(batch_id AS VARCHAR) || '.' AS message,
       query_id, batch_id
FROM prog
UNION ALL
SELECT id, timestamp, level, 'stream_error' AS event_type, 'STABLE' AS maturity_level, exception_message AS message,
       query_id, batch_id
FROM errs""")

ORACLE["silver_streaming_metrics"] = with_(["prog"], """
SELECT id, timestamp,
       'Completed streaming update for ''' || query_name || ''' batch ' || CAST(batch_id AS VARCHAR) || '.' AS message,
       'METRICS' AS level, 'stream_progress' AS event_type, 'STABLE' AS maturity_level,
       environment, workspace_id, '' AS domain, '' AS owner, 'medium' AS criticality
FROM prog""")

ORACLE["silver_stream_errors"] = with_(["errs"], """
SELECT query_id, query_name, batch_id, timestamp, exception_type, exception_message, termination_reason,
       CAST(NULL AS INTEGER) AS restart_count, stack_trace, environment, workspace_id
FROM errs""")

ORACLE["silver_sla_latency"] = with_(["sla"], """
SELECT query_id, query_name, batch_id, timestamp, event_time_min, event_time_max, processing_time,
       latency_ms, latency_ms AS latency_p50, latency_ms AS latency_p90, latency_ms AS latency_p99, latency_ms AS max_latency,
       sla_breach_flag, sla_threshold_ms, environment, workspace_id
FROM sla""")

ORACLE["silver_data_quality"] = with_(["prog"], """
SELECT query_id, query_name, batch_id, timestamp, duplicate_rate, dropped_record_count,
       schema_change_detected, value_null_rate, late_record_percentage, environment, workspace_id
FROM prog WHERE has_quality""")

ORACLE["silver_progress"] = with_(["prog"], """
SELECT query_id, query_name, batch_id, timestamp, trigger_ts, batch_duration_ms, num_input_rows,
       input_rows_per_second, processed_rows_per_second, event_time_min, event_time_max, watermark,
       state_memory_bytes, state_rows_total, has_quality
FROM prog""")

ORACLE["event_log_record"] = with_(["prog"], """
SELECT sha256(concat_ws('|', 'r-' || event_type, CAST(batch_id AS VARCHAR))) AS id, batch_id,
       query_name AS flow_name, query_id AS flow_id, timestamp,
       'Completed streaming update for ''' || query_name || ''' batch ' || CAST(batch_id AS VARCHAR) || '.' AS message,
       'METRICS' AS level, 'stream_progress' AS event_type, 'STABLE' AS maturity_level
FROM prog""")

ORACLE["tag_enrichment"] = with_(["prog"], """
SELECT id, query_id,
       CASE WHEN event_type IN ('click', 'view') THEN 'web' WHEN event_type = 'purchase' THEN 'commerce' ELSE 'platform' END AS domain,
       'team-' || event_type AS owner,
       CASE WHEN event_type = 'purchase' THEN 'high' WHEN event_type = 'error' THEN 'medium' ELSE 'low' END AS criticality
FROM prog""")

ORACLE["sanitize_names"] = r"""
SELECT event_id, raw_name,
       COALESCE(NULLIF(lower(regexp_replace(regexp_replace(raw_name, '^\s+|\s+$', '', 'g'), '[^a-zA-Z0-9_\-.]', '_', 'g')), ''),
                'unnamed_stream') AS query_name
FROM (SELECT event_id,
             CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN '   '
                  ELSE ' My ' || event_type || '/' || props || ' ' END AS raw_name
      FROM events) t"""

ORACLE["restart_counts"] = with_(["errs"], """
SELECT query_id, timestamp, exception_message, restart_count FROM errs_rc""")

ORACLE["severity_tiers"] = with_(["prog"], """
SELECT query_id, batch_id,
       CASE WHEN lat IS NULL THEN NULL WHEN lat > 60000 THEN 'CRITICAL' WHEN lat > 30000 THEN 'WARNING' ELSE 'OK' END AS latency_tier,
       CASE WHEN batch_duration_ms IS NULL THEN NULL WHEN batch_duration_ms > 60000 THEN 'CRITICAL'
            WHEN batch_duration_ms > 30000 THEN 'WARNING' ELSE 'OK' END AS duration_tier
FROM (SELECT *, epoch_ms(timestamp) - epoch_ms(event_time_max) AS lat FROM prog) p""")

# ------------------------------------------------------------ overview ------

ORACLE["lookback_days"] = with_(["prog"], f"""
SELECT query_id, batch_id, timestamp FROM prog WHERE environment = 'prod' AND {WEEK_END}""")

LB = f"""SELECT query_id, query_name, MAX(timestamp) AS last_batch_ts, MAX(batch_id) AS last_batch_id,
       MIN(timestamp) AS first_batch_ts
FROM prog WHERE environment = 'prod' AND {ALL_OVERVIEW} GROUP BY query_id, query_name"""
ES = f"""SELECT query_id, MAX(timestamp) AS last_error_ts FROM errs_rc
WHERE environment = 'prod' AND {ALL_OVERVIEW} GROUP BY query_id"""
SB = f"""SELECT query_id, COUNT(*) AS breach_count FROM sla
WHERE environment = 'prod' AND sla_breach_flag AND {ALL_OVERVIEW} GROUP BY query_id"""

ORACLE["latest_batch"] = with_(["prog"], LB)
ORACLE["last_error"] = with_(["errs"], ES)
ORACLE["breach_counts"] = with_(["sla"], SB)
ORACLE["stream_overview"] = with_(["sla", "errs"], f"""
, lb AS ({LB}), es AS ({ES}), sb AS ({SB})
SELECT lb.query_id, lb.query_name,
       CASE WHEN es.last_error_ts > lb.last_batch_ts THEN 'ERROR'
            WHEN lb.last_batch_ts < {AS_OF_OVERVIEW} - INTERVAL 10 MINUTE THEN 'INACTIVE'
            ELSE 'ACTIVE' END AS stream_status,
       lb.last_batch_ts, lb.last_batch_id, lb.first_batch_ts,
       CAST(CAST(floor(epoch(lb.last_batch_ts)) - floor(epoch(lb.first_batch_ts)) AS DECIMAL(20,0)) / 3600 AS DECIMAL(10,1)) AS uptime_hours,
       COALESCE(sb.breach_count, 0) AS sla_breach_count,
       COALESCE(sb.breach_count, 0) > 0 AS has_sla_breaches,
       es.last_error_ts
FROM lb LEFT JOIN es ON lb.query_id = es.query_id LEFT JOIN sb ON lb.query_id = sb.query_id""")

# -------------------------------------------------------------- trends ------

ORACLE["throughput_trends"] = with_(["prog"], f"""
SELECT query_name, time_bucket(INTERVAL '1 minute', timestamp) AS time_bucket,
       {r('AVG(input_rows_per_second)', 2)} AS avg_input_rows_per_sec,
       {r('AVG(processed_rows_per_second)', 2)} AS avg_processed_rows_per_sec,
       {r('AVG(batch_duration_ms)', 0)} AS avg_batch_duration_ms,
       MAX(batch_duration_ms) AS max_batch_duration_ms,
       CAST(SUM(num_input_rows) AS BIGINT) AS total_input_rows,
       {r('AVG(CAST(floor(epoch(timestamp)) AS BIGINT) - CAST(floor(epoch(watermark)) AS BIGINT))', 0)} AS avg_watermark_delay_sec
FROM prog WHERE environment = 'prod' AND {WEEK_END}
GROUP BY 1, 2""")

ORACLE["latency_sla"] = with_(["sla"], f"""
SELECT query_name, time_bucket(INTERVAL '5 minutes', timestamp) AS time_bucket,
       quantile_disc(latency_ms, 0.5) AS p50_latency_ms, quantile_disc(latency_ms, 0.9) AS p90_latency_ms,
       quantile_disc(latency_ms, 0.99) AS p99_latency_ms, MAX(latency_ms) AS max_latency_ms,
       CAST(SUM(CASE WHEN sla_breach_flag THEN 1 ELSE 0 END) AS BIGINT) AS breach_count,
       COUNT(*) AS batch_count,
       {r('100.0 * SUM(CASE WHEN sla_breach_flag THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE)', 2)} AS breach_percentage,
       sla_threshold_ms
FROM sla WHERE environment = 'prod' AND {WEEK_END} AND latency_ms IS NOT NULL
GROUP BY 1, 2, sla_threshold_ms""")

ORACLE["data_quality_hourly"] = with_(["prog"], f"""
SELECT query_name, date_trunc('hour', timestamp) AS time_bucket,
       {r('AVG(duplicate_rate) * 100', 2)} AS avg_duplicate_rate_pct,
       CAST(SUM(dropped_record_count) AS BIGINT) AS total_dropped_records,
       {r('AVG(late_record_percentage) * 100', 2)} AS avg_late_record_pct,
       CAST(SUM(CASE WHEN schema_change_detected THEN 1 ELSE 0 END) AS BIGINT) AS schema_change_count, COUNT(*) AS batch_count
FROM prog WHERE has_quality AND environment = 'prod' AND {WEEK_END}
GROUP BY 1, 2""")

ORACLE["infra_cost_hourly"] = with_(["infra"], f"""
SELECT cluster_id, date_trunc('hour', timestamp) AS time_bucket,
       {r('AVG(cpu_usage_percent)', 1)} AS avg_cpu_pct, MAX(cpu_usage_percent) AS max_cpu_pct,
       {r('AVG(memory_usage_percent)', 1)} AS avg_memory_pct, MAX(memory_usage_percent) AS max_memory_pct,
       {r('AVG(executor_count)', 0)} AS avg_executor_count, MAX(executor_count) AS max_executor_count,
       {r('SUM(COALESCE(dbu_consumption, 0))', 2)} AS total_dbu,
       CAST(SUM(CASE WHEN autoscaling_event = 'SCALE_UP' THEN 1 ELSE 0 END) AS BIGINT) AS scale_up_count,
       CAST(SUM(CASE WHEN autoscaling_event = 'SCALE_DOWN' THEN 1 ELSE 0 END) AS BIGINT) AS scale_down_count
FROM infra WHERE environment = 'prod' AND {WEEK_END}
GROUP BY 1, 2""")

# -------------------------------------------------------------- frames ------

ORACLE["backpressure"] = with_(["prog"], f"""
SELECT query_name, batch_id, timestamp, input_rows_per_second, processed_rows_per_second,
       CASE WHEN processed_rows_per_second > 0 THEN {r('input_rows_per_second / processed_rows_per_second', 3)} END AS backpressure_ratio,
       sustained_count,
       CASE WHEN sustained_count >= 5 THEN 'CRITICAL' WHEN sustained_count >= 3 THEN 'WARNING' ELSE 'OK' END AS backpressure_status
FROM (SELECT *, CAST(SUM(CASE WHEN input_rows_per_second > processed_rows_per_second THEN 1 ELSE 0 END)
                     OVER (PARTITION BY query_id ORDER BY batch_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS sustained_count
      FROM prog WHERE environment = 'prod' AND {MONTH_END}) w""")

ORACLE["state_operator_totals"] = with_(["prog"], f"""
SELECT query_id, batch_id, timestamp, state_memory_bytes, state_rows_total
FROM prog WHERE environment = 'prod' AND {MONTH_END}""")

ORACLE["state_store_health"] = with_(["prog"], f"""
SELECT query_name, timestamp, batch_id, {r('state_memory_bytes / 1048576.0', 2)} AS state_memory_mb, state_rows_total,
       CASE WHEN prev > 0 THEN {r('100.0 * CAST(state_memory_bytes - prev AS DOUBLE) / CAST(prev AS DOUBLE)', 2)} ELSE 0.0 END AS memory_growth_pct
FROM (SELECT *, LAG(state_memory_bytes) OVER (PARTITION BY query_id ORDER BY batch_id) AS prev
      FROM prog WHERE environment = 'prod' AND {MONTH_END} AND state_memory_bytes > 0) w""")

# -------------------------------------------------------------- alerts ------

ORACLE["alert_sla_breach"] = with_(["sla"], f"""
SELECT query_name, COUNT(*) AS breach_count, MAX(latency_ms) AS max_latency_ms, MAX(sla_threshold_ms) AS sla_threshold_ms
FROM sla WHERE environment = 'prod' AND sla_breach_flag AND {lookback_minutes(AS_OF_END, DAY)}
GROUP BY query_name HAVING COUNT(*) > 0""")

ORACLE["alert_backpressure"] = with_(["prog"], f"""
SELECT query_name, backpressured_count FROM (
  SELECT query_id, query_name, CAST(SUM(bp) AS BIGINT) AS backpressured_count
  FROM (SELECT query_id, query_name, CASE WHEN input_rows_per_second > processed_rows_per_second THEN 1 ELSE 0 END AS bp,
               ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY batch_id DESC) AS rn
        FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, WEEK)}) x
  WHERE rn <= 5 GROUP BY query_id, query_name) y
WHERE backpressured_count >= 4""")

ORACLE["alert_duration_spike"] = with_(["prog"], f"""
SELECT query_name, batch_id, batch_duration_ms, {r('avg20', 0)} AS rolling_avg_duration_ms,
       {r('batch_duration_ms / NULLIF(avg20, 0)', 2)} AS spike_factor
FROM (SELECT *, AVG(batch_duration_ms) OVER (PARTITION BY query_id ORDER BY batch_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS avg20
      FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, MONTH)}) x
WHERE batch_duration_ms > 3.0 * avg20 AND avg20 IS NOT NULL
ORDER BY spike_factor DESC, query_id, batch_id LIMIT 10""")

ORACLE["alert_terminated"] = with_(["errs"], f"""
SELECT query_id, query_name, timestamp AS terminated_at, exception_type, exception_message, termination_reason, restart_count
FROM errs_rc WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, DAY)}""")

ORACLE["alert_state_growth"] = with_(["prog"], f"""
SELECT DISTINCT p.query_name, {r('s / 1048576.0', 2)} AS memory_start_mb, {r('e / 1048576.0', 2)} AS memory_end_mb,
       {r('100.0 * (e - s) / s', 2)} AS growth_pct
FROM (SELECT query_id, CAST(arg_min(state_memory_bytes, (timestamp, batch_id)) AS DOUBLE) AS s,
             CAST(arg_max(state_memory_bytes, (timestamp, batch_id)) AS DOUBLE) AS e
      FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, WEEK)} GROUP BY query_id) g
JOIN (SELECT DISTINCT query_id, query_name FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, WEEK)}) p
  ON g.query_id = p.query_id
WHERE s > 0 AND 100.0 * (e - s) / s > 20.0""")

# ------------------------------------------------------- expectations -------

ORACLE["expectation_counts"] = with_(["sla", "errs"], """
, tot AS (SELECT (SELECT COUNT(*) FROM prog) AS np, (SELECT COUNT(*) FROM errs) AS ne)
SELECT 'valid_timestamp' AS expectation, np + ne AS total_records, CAST(0 AS BIGINT) AS failed_records, np + ne AS passed_records FROM tot
UNION ALL SELECT 'valid_event_type', np + ne, 0, np + ne FROM tot
UNION ALL SELECT 'valid_details', np + ne, 0, np + ne FROM tot
UNION ALL SELECT 'is_stream_progress', np + ne, ne, np FROM tot
UNION ALL SELECT 'has_event_time', COUNT(*), COUNT(*) - COUNT(event_time_max), COUNT(event_time_max) FROM sla""")

ORACLE["expectation_drop"] = with_(["prog", "errs"], """
SELECT 'is_error_event' AS expectation, (SELECT COUNT(*) FROM errs) AS kept_records, (SELECT COUNT(*) FROM prog) AS dropped_records""")

# ------------------------------------------------------------ quality -------

ORACLE["null_rates"] = with_(["infra"], """
SELECT cluster_id, date_trunc('hour', timestamp) AS hour, COUNT(*) AS record_count,
       CAST(0 AS DOUBLE) AS cpu_null_rate,
       (COUNT(*) - COUNT(dbu_consumption)) / CAST(COUNT(*) AS DOUBLE) AS dbu_null_rate,
       (COUNT(*) - COUNT(autoscaling_event)) / CAST(COUNT(*) AS DOUBLE) AS autoscale_null_rate
FROM infra GROUP BY 1, 2""")

ORACLE["duplicate_rate"] = f"""
SELECT event_type, {BN} AS batch_id, COUNT(*) AS record_count, COUNT(DISTINCT user_id) AS distinct_keys,
       (COUNT(*) - COUNT(DISTINCT user_id)) / CAST(COUNT(*) AS DOUBLE) AS duplicate_rate
FROM events GROUP BY 1, 2"""

ORACLE["schema_drift"] = with_(["mb"], """
SELECT query_id, batch_id, CASE WHEN no_et THEN 14 ELSE 15 END AS key_count,
       COALESCE(prev_no_et IS NOT NULL AND prev_no_et <> no_et, false) AS schema_change_detected
FROM (SELECT 'q-' || event_type AS query_id, batch_id, n % 6 = 0 AS no_et,
             LAG(n % 6 = 0) OVER (PARTITION BY event_type ORDER BY batch_id) AS prev_no_et FROM mb) x""")

ORACLE["late_fraction"] = """
WITH o AS (SELECT o_orderstatus AS stream, CAST(floor(o_orderkey / 1024) AS BIGINT) AS batch_id, o_orderdate AS event_time FROM orders),
b AS (SELECT stream, batch_id, MAX(event_time) AS bmax FROM o GROUP BY 1, 2),
w AS (SELECT stream, batch_id,
             MAX(bmax) OVER (PARTITION BY stream ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 365 DAY AS wm
      FROM b)
SELECT o.stream, o.batch_id, COUNT(*) AS record_count,
       CAST(SUM(CASE WHEN o.event_time < w.wm THEN 1 ELSE 0 END) AS BIGINT) AS late_records,
       AVG(CASE WHEN o.event_time < w.wm THEN 1.0 ELSE 0.0 END) AS late_record_percentage
FROM o JOIN w ON o.stream = w.stream AND o.batch_id = w.batch_id GROUP BY 1, 2"""

# ------------------------------------------------------- inspection ---------

ORACLE["recent_metrics"] = with_(["prog"], """
SELECT query_id, query_name, batch_id, timestamp, input_rows_per_second, batch_duration_ms
FROM prog ORDER BY timestamp DESC, query_id DESC LIMIT 20""")

ORACLE["recent_sla"] = with_(["sla"], """
SELECT query_id, query_name, batch_id, timestamp, latency_ms, sla_breach_flag
FROM sla ORDER BY timestamp DESC, query_id DESC LIMIT 20""")

ORACLE["recent_quality"] = with_(["prog"], """
SELECT query_id, batch_id, timestamp, duplicate_rate, dropped_record_count, late_record_percentage
FROM prog WHERE has_quality ORDER BY timestamp DESC, query_id DESC LIMIT 10""")

ORACLE["table_row_counts"] = with_(["prog", "errs"], """
SELECT 'raw_events' AS table_name, (SELECT COUNT(*) FROM prog) + (SELECT COUNT(*) FROM errs) AS row_count
UNION ALL SELECT 'streaming_metrics', COUNT(*) FROM prog
UNION ALL SELECT 'stream_errors', COUNT(*) FROM errs
UNION ALL SELECT 'sla_latency_metrics', COUNT(*) FROM prog
UNION ALL SELECT 'data_quality_metrics', COUNT(*) FROM prog WHERE has_quality
UNION ALL SELECT 'infrastructure_metrics', COUNT(*) FROM events""")

# -------------------------------------------------------------- infra -------

ORACLE["infra_usage_normalize"] = f"""
SELECT 'c-' || CAST(user_id % 8 AS VARCHAR) AS cluster_id, ts AS timestamp,
       CAST(NULL AS DOUBLE) AS cpu_usage_percent, CAST(NULL AS DOUBLE) AS memory_usage_percent,
       CAST(NULL AS INTEGER) AS executor_count, CAST(NULL AS VARCHAR) AS autoscaling_event,
       {r('value / 3', 2)} AS dbu_consumption,
       CAST(NULL AS VARCHAR) AS driver_node_type, CAST(NULL AS VARCHAR) AS worker_node_type,
       'prod' AS environment, 'ws-0001' AS workspace_id
FROM events WHERE event_id % 13 <> 0 AND ts >= CAST({AS_OF_END} AS DATE) - INTERVAL 7 DAY"""

ORACLE["autoscale_events"] = with_(["infra"], """
SELECT cluster_id, sample_id, timestamp, executor_count, autoscaling_event FROM infra""")
ORACLE["autoscale_events_split"] = ORACLE["autoscale_events"]
ORACLE["backpressure_split"] = ORACLE["backpressure"]

# ---------------------------------------------------------- evaluation ------

EVALS = f"""
, ev AS (
  SELECT 'streaming_sla_breach' AS name, query_name AS entity, CAST(COUNT(*) AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold, 'critical' AS severity
  FROM sla WHERE environment = 'prod' AND sla_breach_flag AND {lookback_minutes(AS_OF_END, DAY)} GROUP BY query_name
  UNION ALL
  SELECT 'streaming_sustained_backpressure', query_name, CAST(SUM(bp) AS DOUBLE), 4.0, 'warning'
  FROM (SELECT query_id, query_name, CASE WHEN input_rows_per_second > processed_rows_per_second THEN 1 ELSE 0 END AS bp,
               ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY batch_id DESC) AS rn
        FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, WEEK)}) x
  WHERE rn <= 5 GROUP BY query_id, query_name
  UNION ALL
    SELECT 'streaming_batch_duration_spike', query_name || '/' || CAST(batch_id AS VARCHAR), batch_duration_ms / NULLIF(avg20, 0), 3.0, 'warning'
    FROM (SELECT *, AVG(batch_duration_ms) OVER (PARTITION BY query_id ORDER BY batch_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS avg20
          FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, MONTH)}) x
    WHERE batch_duration_ms > 3.0 * avg20 AND avg20 IS NOT NULL
  UNION ALL
  SELECT 'streaming_stream_terminated', query_id, CAST(COUNT(*) AS DOUBLE), 0.0, 'failure'
  FROM errs WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, DAY)} GROUP BY query_id
  UNION ALL
  SELECT 'streaming_state_memory_growth', p.query_name, {r('100.0 * (e - s) / s', 2)}, 20.0, 'warning'
  FROM (SELECT query_id, CAST(arg_min(state_memory_bytes, (timestamp, batch_id)) AS DOUBLE) AS s,
               CAST(arg_max(state_memory_bytes, (timestamp, batch_id)) AS DOUBLE) AS e
        FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, WEEK)} GROUP BY query_id) g
  JOIN (SELECT DISTINCT query_id, query_name FROM prog WHERE environment = 'prod' AND {lookback_minutes(AS_OF_END, WEEK)}) p
    ON g.query_id = p.query_id
  WHERE s > 0)"""

ORACLE["alert_evaluate"] = with_(["sla", "errs"], EVALS + """
SELECT name, entity, value, threshold, severity, value > threshold AS fired FROM ev""")

DESCRIPTIONS = """
, d AS (SELECT * FROM (VALUES
  ('streaming_sla_breach', 'Fires when any stream exceeds its SLA latency threshold.'),
  ('streaming_sustained_backpressure', 'Fires when input > processed for 5+ consecutive batches.'),
  ('streaming_batch_duration_spike', 'Fires when batch duration exceeds 3x the rolling average.'),
  ('streaming_stream_terminated', 'Fires immediately when any streaming query terminates.'),
  ('streaming_state_memory_growth', 'Fires when state store memory grows >20% within 30 minutes.')) t(name, description)),
ch AS (SELECT * FROM (VALUES ('critical', 'pagerduty'), ('failure', 'pagerduty'), ('warning', 'slack')) t(severity, channel))"""

ORACLE["alert_routing"] = with_(["sla", "errs"], EVALS + DESCRIPTIONS + """
SELECT ev.name, ev.entity, ev.severity, ch.channel,
       'Alert: ' || ev.name || chr(10) || 'Severity: ' || ev.severity || chr(10) || 'Environment: prod' || chr(10)
       || 'Description: ' || d.description AS message
FROM ev JOIN d ON ev.name = d.name LEFT JOIN ch ON ev.severity = ch.severity
WHERE ev.value > ev.threshold""")

BACKTEST = """
, bt_rows AS (
  SELECT query_name AS entity,
         unnest(generate_series(CAST(ceil(e / 300) * 300 AS BIGINT), CAST(floor((e + 600) / 300) * 300 AS BIGINT), 300)) AS t
  FROM (SELECT query_name, CAST(floor(epoch(timestamp)) AS BIGINT) AS e FROM sla WHERE sla_breach_flag AND environment = 'prod') x),
bt AS (
  SELECT 'streaming_sla_breach' AS name, entity, TIMESTAMP '1970-01-01 00:00:00' + t * INTERVAL 1 SECOND AS evaluated_at,
         CAST(COUNT(*) AS DOUBLE) AS value, COUNT(*) > 0 AS fired
  FROM bt_rows WHERE t >= 1704067200 AND t <= 1706659200 GROUP BY entity, t)"""

ORACLE["alert_backtest"] = with_(["sla"], BACKTEST + """
SELECT name, entity, evaluated_at, value, fired FROM bt""")

ORACLE["alert_rearm"] = "WITH RECURSIVE " + with_(["sla"], BACKTEST + """
, f AS (SELECT name, entity, evaluated_at, ROW_NUMBER() OVER (PARTITION BY name, entity ORDER BY evaluated_at) AS rn FROM bt WHERE fired),
walk AS (
  SELECT name, entity, rn, evaluated_at, evaluated_at AS last_kept, true AS notified FROM f WHERE rn = 1
  UNION ALL
  SELECT f.name, f.entity, f.rn, f.evaluated_at,
         CASE WHEN epoch(f.evaluated_at) - epoch(w.last_kept) >= 600 THEN f.evaluated_at ELSE w.last_kept END,
         epoch(f.evaluated_at) - epoch(w.last_kept) >= 600
  FROM walk w JOIN f ON f.name = w.name AND f.entity = w.entity AND f.rn = w.rn + 1)
SELECT name, entity, evaluated_at, notified FROM walk""")[len("WITH "):]

# ---------------------------------------------------------- lifecycle -------

ORACLE["retention_filter"] = with_(["prog", "errs"], """
SELECT event_date, COUNT(*) AS row_count FROM (
  SELECT CAST(timestamp AS DATE) AS event_date FROM prog UNION ALL SELECT CAST(timestamp AS DATE) FROM errs) x
WHERE event_date >= DATE '2024-01-11' GROUP BY 1""")

ORACLE["streamed_table_lifecycle"] = with_(["errs"], """
SELECT CAST(timestamp AS DATE) AS event_date, COUNT(*) AS row_count, COUNT(DISTINCT exception_message) AS distinct_messages
FROM errs WHERE CAST(timestamp AS DATE) >= DATE '2024-01-11' GROUP BY 1""")

ORACLE["compaction_preserves_rows"] = with_(["prog", "errs"], """
SELECT CAST(timestamp AS DATE) AS event_date, COUNT(*) AS row_count, COUNT(DISTINCT id) AS distinct_ids, MIN(id) AS min_id, MAX(id) AS max_id
FROM (SELECT timestamp, id FROM prog UNION ALL SELECT timestamp, id FROM errs) x GROUP BY 1""")

# ---------------------------------------------------------- streaming -------

READINGS = """readings AS (
  SELECT printf('sensor-%04d', user_id) AS sensor_id, value AS temperature, value / 2 AS humidity, 1000.0 + value / 10 AS pressure,
         ts AS event_time, event_type AS region, (['plant-A', 'plant-B', 'warehouse-C', 'lab-D'])[event_id % 4 + 1] AS facility
  FROM events)"""
CTE["readings"] = READINGS
NEEDS["readings"] = []

ORACLE["sensor_ingest"] = with_(["readings"], """
SELECT sensor_id, temperature, humidity, CAST(pressure AS DOUBLE) AS pressure, event_time, region, facility FROM readings""")

ORACLE["incremental_equals_batch"] = with_(["readings"], """
SELECT region, CAST(event_time AS DATE) AS day, COUNT(*) AS record_count, COUNT(DISTINCT sensor_id) AS distinct_sensors
FROM readings GROUP BY 1, 2""")

ORACLE["sensor_window_agg"] = with_(["readings"], f"""
, w AS (SELECT *, time_bucket(INTERVAL 30 SECOND, event_time) AS b FROM readings),
x AS (SELECT b AS window_start, * FROM w UNION ALL SELECT b - INTERVAL 30 SECOND AS window_start, * FROM w)
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, region, COUNT(sensor_id) AS sensor_count,
       {r('AVG(temperature)', 6)} AS avg_temperature, MAX(temperature) AS max_temperature, MIN(temperature) AS min_temperature,
       {r('AVG(humidity)', 6)} AS avg_humidity, COUNT(*) AS record_count
FROM x GROUP BY window_start, region
HAVING window_start + INTERVAL 1 MINUTE <= (SELECT MAX(ts) FROM events) - INTERVAL 30 SECOND""")

ORACLE["foreach_batch_quality"] = with_(["readings"], """
SELECT CAST(event_time AS DATE) AS day, COUNT(*) AS record_count, COUNT(DISTINCT sensor_id) AS distinct_sensors,
       (COUNT(*) - COUNT(DISTINCT sensor_id)) / CAST(COUNT(*) AS DOUBLE) AS duplicate_rate,
       CAST(0 AS DOUBLE) AS temperature_null_rate
FROM readings GROUP BY 1""")

ORACLE["backpressure_stream"] = with_(["prog"], """
SELECT query_name, batch_id, sustained_count,
       CASE WHEN sustained_count >= 5 THEN 'CRITICAL' WHEN sustained_count >= 3 THEN 'WARNING' ELSE 'OK' END AS backpressure_status
FROM (SELECT *, CAST(SUM(CASE WHEN input_rows_per_second > processed_rows_per_second THEN 1 ELSE 0 END)
                     OVER (PARTITION BY query_id ORDER BY batch_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS sustained_count
      FROM prog) w""")
ORACLE["materialize_datasets"] = ORACLE["stream_overview"]
ORACLE["silver_flow_stream"] = ORACLE["silver_sla_latency"]
ORACLE["monitoring_tables"] = with_(["prog", "errs"], """
SELECT 'raw_events' AS table_name, (SELECT COUNT(*) FROM prog) + (SELECT COUNT(*) FROM errs) AS row_count
UNION ALL SELECT 'streaming_metrics', COUNT(*) FROM prog
UNION ALL SELECT 'stream_errors', COUNT(*) FROM errs
UNION ALL SELECT 'sla_latency_metrics', COUNT(*) FROM prog
UNION ALL SELECT 'data_quality_metrics', COUNT(*) FROM prog WHERE has_quality
UNION ALL SELECT 'infrastructure_metrics', COUNT(*) FROM events
UNION ALL SELECT 'sensor_bronze', COUNT(*) FROM events
UNION ALL SELECT 'sensor_gold', 0""")


def _ranked(sql: str, order: str) -> str:
    return f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS display_rank FROM ({sql}) ranked"


for _n, _order in (
    ("stream_overview", "query_name"),
    ("throughput_trends", "query_name, time_bucket"),
    ("latency_sla", "query_name, time_bucket"),
    ("backpressure", "query_name, batch_id DESC"),
    ("state_store_health", "query_name, batch_id"),
    ("data_quality_hourly", "query_name, time_bucket"),
    ("infra_cost_hourly", "cluster_id, time_bucket"),
):
    ORACLE[f"sql_{_n}"] = _ranked(ORACLE[_n], _order)

ORACLE["alert_backtest_terminated"] = with_(["errs"], """
, r AS (
  SELECT query_id AS entity,
         unnest(generate_series(CAST(ceil(e / 60) * 60 AS BIGINT), CAST(floor((e + 600) / 60) * 60 AS BIGINT), 60)) AS t
  FROM (SELECT query_id, CAST(floor(epoch(timestamp)) AS BIGINT) AS e FROM errs WHERE environment = 'prod') x)
SELECT 'streaming_stream_terminated' AS name, entity, TIMESTAMP '1970-01-01 00:00:00' + t * INTERVAL 1 SECOND AS evaluated_at,
       CAST(COUNT(*) AS DOUBLE) AS value, COUNT(*) > 0 AS fired
FROM r WHERE t >= 1704067200 AND t <= 1706659200 GROUP BY entity, t""")

ORACLE["alert_backtest_state_growth"] = with_(["prog"], f"""
, r AS (
  SELECT query_name, timestamp, batch_id, state_memory_bytes,
         unnest(generate_series(CAST(ceil(e / 600) * 600 AS BIGINT), CAST(floor((e + 10800) / 600) * 600 AS BIGINT), 600)) AS t
  FROM (SELECT *, CAST(floor(epoch(timestamp)) AS BIGINT) AS e FROM prog WHERE environment = 'prod') x),
g AS (
  SELECT query_name, t, CAST(arg_min(state_memory_bytes, (timestamp, batch_id)) AS DOUBLE) AS s,
         CAST(arg_max(state_memory_bytes, (timestamp, batch_id)) AS DOUBLE) AS e
  FROM r WHERE t >= 1704067200 AND t <= 1706659200 GROUP BY query_name, t)
SELECT 'streaming_state_memory_growth' AS name, query_name AS entity, TIMESTAMP '1970-01-01 00:00:00' + t * INTERVAL 1 SECOND AS evaluated_at,
       {r('100.0 * (e - s) / s', 2)} AS value, {r('100.0 * (e - s) / s', 2)} > 20.0 AS fired
FROM g WHERE s > 0""")

ORACLE["alert_backtest_backpressure"] = with_(["prog"], """
, r AS (
  SELECT query_id, query_name, batch_id, CASE WHEN input_rows_per_second > processed_rows_per_second THEN 1 ELSE 0 END AS bp,
         unnest(generate_series(CAST(ceil(e / 3600) * 3600 AS BIGINT), CAST(floor((e + 21600) / 3600) * 3600 AS BIGINT), 3600)) AS t
  FROM (SELECT *, CAST(floor(epoch(timestamp)) AS BIGINT) AS e FROM prog WHERE environment = 'prod') x),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY t, query_id ORDER BY batch_id DESC) AS rn FROM r WHERE t >= 1704067200 AND t <= 1706659200)
SELECT 'streaming_sustained_backpressure' AS name, query_name AS entity, TIMESTAMP '1970-01-01 00:00:00' + t * INTERVAL 1 SECOND AS evaluated_at,
       CAST(SUM(bp) AS DOUBLE) AS value, SUM(bp) > 4 AS fired
FROM k WHERE rn <= 5 GROUP BY t, query_id, query_name""")

ORACLE["alert_backtest_duration_spike"] = with_(["prog"], f"""
, r AS (
  SELECT query_id, query_name, batch_id, batch_duration_ms,
         unnest(generate_series(CAST(ceil(e / 3600) * 3600 AS BIGINT), CAST(floor((e + 86400) / 3600) * 3600 AS BIGINT), 3600)) AS t
  FROM (SELECT *, CAST(floor(epoch(timestamp)) AS BIGINT) AS e FROM prog WHERE environment = 'prod') x),
w AS (
  SELECT *, AVG(batch_duration_ms) OVER (PARTITION BY t, query_id ORDER BY batch_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS a
  FROM r WHERE t >= 1704067200 AND t <= 1706659200),
c AS (
  SELECT *, batch_duration_ms / NULLIF(a, 0) AS raw
  FROM w WHERE batch_duration_ms > 3.0 * a AND a IS NOT NULL)
SELECT 'streaming_batch_duration_spike' AS name, query_name || '/' || CAST(batch_id AS VARCHAR) AS entity,
       TIMESTAMP '1970-01-01 00:00:00' + t * INTERVAL 1 SECOND AS evaluated_at, raw AS value, raw > 3.0 AS fired
FROM c""")

ORACLE["throughput_trends_stream"] = with_(["prog"], f"""
SELECT query_name, time_bucket(INTERVAL '1 minute', timestamp) AS time_bucket,
       {r('AVG(input_rows_per_second)', 2)} AS avg_input_rows_per_sec,
       {r('AVG(processed_rows_per_second)', 2)} AS avg_processed_rows_per_sec,
       {r('AVG(batch_duration_ms)', 0)} AS avg_batch_duration_ms,
       MAX(batch_duration_ms) AS max_batch_duration_ms,
       CAST(SUM(num_input_rows) AS BIGINT) AS total_input_rows,
       {r('AVG(CAST(floor(epoch(timestamp)) AS BIGINT) - CAST(floor(epoch(watermark)) AS BIGINT))', 0)} AS avg_watermark_delay_sec
FROM prog
GROUP BY 1, 2
HAVING time_bucket(INTERVAL '1 minute', timestamp) + INTERVAL 1 MINUTE <= (SELECT MAX(timestamp) FROM prog) - INTERVAL 10 MINUTE""")

ORACLE["latency_sla_stream"] = with_(["sla"], f"""
SELECT query_name, time_bucket(INTERVAL '5 minutes', timestamp) AS time_bucket,
       quantile_disc(latency_ms, 0.5) AS p50_latency_ms, quantile_disc(latency_ms, 0.9) AS p90_latency_ms,
       quantile_disc(latency_ms, 0.99) AS p99_latency_ms, MAX(latency_ms) AS max_latency_ms,
       CAST(SUM(CASE WHEN sla_breach_flag THEN 1 ELSE 0 END) AS BIGINT) AS breach_count,
       COUNT(*) AS batch_count,
       {r('100.0 * SUM(CASE WHEN sla_breach_flag THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE)', 2)} AS breach_percentage,
       sla_threshold_ms
FROM sla WHERE latency_ms IS NOT NULL
GROUP BY 1, 2, sla_threshold_ms
HAVING time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL 5 MINUTE <= (SELECT MAX(timestamp) FROM prog) - INTERVAL 10 MINUTE""")

ORACLE["gold_incremental_refresh"] = with_(["prog"], f"""
SELECT query_name, time_bucket(INTERVAL '1 minute', timestamp) AS time_bucket,
       {r('AVG(input_rows_per_second)', 2)} AS avg_input_rows_per_sec,
       {r('AVG(processed_rows_per_second)', 2)} AS avg_processed_rows_per_sec,
       {r('AVG(batch_duration_ms)', 0)} AS avg_batch_duration_ms,
       MAX(batch_duration_ms) AS max_batch_duration_ms,
       CAST(SUM(num_input_rows) AS BIGINT) AS total_input_rows,
       {r('AVG(CAST(floor(epoch(timestamp)) AS BIGINT) - CAST(floor(epoch(watermark)) AS BIGINT))', 0)} AS avg_watermark_delay_sec
FROM prog WHERE timestamp <= {AS_OF_END}
GROUP BY 1, 2""")
for _n, _order in (
    ("sla_breach", "query_name"),
    ("backpressure", "query_name"),
    ("duration_spike", "spike_factor DESC, query_name, batch_id"),
    ("terminated", "terminated_at DESC, query_id, exception_message"),
    ("state_growth", "query_name"),
):
    ORACLE[f"sql_alert_{_n}"] = _ranked(ORACLE[f"alert_{_n}"], _order)

ORACLE["overview_by_delta"] = ORACLE["stream_overview"]
ORACLE["backpressure_by_delta"] = ORACLE["backpressure"].replace(MONTH_END, lookback_days(AS_OF_END, None))
ORACLE["state_growth_by_delta"] = ORACLE["state_store_health"].replace(MONTH_END, lookback_days(AS_OF_END, None))
ORACLE["infrastructure_datasets"] = ORACLE["infra_cost_hourly"]

ORACLE["observed_metrics"] = with_(["prog"], """
SELECT query_id, query_name, batch_id, timestamp, 'quality' AS observation, metric, value FROM (
  SELECT query_id, query_name, batch_id, timestamp, 'duplicate_rate' AS metric, duplicate_rate AS value FROM prog WHERE has_quality
  UNION ALL
  SELECT query_id, query_name, batch_id, timestamp, 'dropped_record_count', CAST(dropped_record_count AS DOUBLE) FROM prog WHERE has_quality
  UNION ALL
  SELECT query_id, query_name, batch_id, timestamp, 'late_record_percentage', late_record_percentage FROM prog WHERE has_quality) x""")

ORACLE["data_quality_stream"] = with_(["prog"], f"""
SELECT query_name, date_trunc('hour', timestamp) AS time_bucket,
       {r('AVG(duplicate_rate) * 100', 2)} AS avg_duplicate_rate_pct,
       CAST(SUM(dropped_record_count) AS BIGINT) AS total_dropped_records,
       {r('AVG(late_record_percentage) * 100', 2)} AS avg_late_record_pct,
       CAST(SUM(CASE WHEN schema_change_detected THEN 1 ELSE 0 END) AS BIGINT) AS schema_change_count, COUNT(*) AS batch_count
FROM prog WHERE has_quality
GROUP BY 1, 2
HAVING date_trunc('hour', timestamp) + INTERVAL 1 HOUR <= (SELECT MAX(timestamp) FROM prog WHERE has_quality) - INTERVAL 10 MINUTE""")

# ------------------------------------------- live detectors, as-of, rollups --

LIVE_WM = "(SELECT MAX(timestamp) - INTERVAL 2190 MINUTE FROM prog)"

ORACLE["duration_spike_stream"] = with_(["prog"], f"""
SELECT query_id, query_name, batch_id, batch_duration_ms, {r('avg20', 0)} AS rolling_avg_duration_ms,
       {r('batch_duration_ms / NULLIF(avg20, 0)', 2)} AS spike_factor
FROM (SELECT *, AVG(batch_duration_ms) OVER (PARTITION BY query_id ORDER BY batch_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS avg20
      FROM prog WHERE environment = 'prod') x
WHERE batch_duration_ms > 3.0 * avg20 AND timestamp <= {LIVE_WM}""")

ORACLE["stream_status_changes"] = with_(["prog"], f"""
, d AS (SELECT query_id, query_name, timestamp, LAG(timestamp) OVER w AS prv, LEAD(timestamp) OVER w AS nxt
        FROM prog WHERE environment = 'prod' AND timestamp <= {LIVE_WM} WINDOW w AS (PARTITION BY query_id ORDER BY timestamp))
SELECT query_id, query_name, 'ACTIVE' AS stream_status, timestamp AS since FROM d
WHERE prv IS NULL OR timestamp - prv > INTERVAL 60 MINUTE
UNION ALL
SELECT query_id, query_name, 'INACTIVE', timestamp + INTERVAL 60 MINUTE FROM d
WHERE COALESCE(nxt - timestamp > INTERVAL 60 MINUTE, timestamp + INTERVAL 60 MINUTE < {LIVE_WM})""")

ORACLE["tags_as_of"] = with_(["prog"], """
, h AS (SELECT 'q-' || event_type AS query_id, ts AS valid_from, arg_max(value, event_id) AS v, arg_max(user_id, event_id) AS u
        FROM events GROUP BY 1, 2)
SELECT p.query_id, p.batch_id, p.timestamp,
       CASE WHEN h.u IS NULL THEN '' WHEN h.v < 10 THEN 'web' WHEN h.v < 30 THEN 'commerce' ELSE 'platform' END AS domain,
       COALESCE('team-' || CAST(h.u AS VARCHAR), '') AS owner,
       CASE WHEN h.u IS NULL OR h.v < 5 THEN 'medium' WHEN h.v < 20 THEN 'low' ELSE 'high' END AS criticality
FROM prog p ASOF LEFT JOIN h ON p.query_id = h.query_id AND p.timestamp >= h.valid_from""")

ORACLE["latency_rollup_day"] = with_(["sla"], f"""
SELECT query_name, time_bucket(INTERVAL '1 day', timestamp) AS time_bucket,
       quantile_disc(latency_ms, 0.5) AS p50_latency_ms, quantile_disc(latency_ms, 0.9) AS p90_latency_ms,
       quantile_disc(latency_ms, 0.99) AS p99_latency_ms, MAX(latency_ms) AS max_latency_ms,
       CAST(SUM(CASE WHEN sla_breach_flag THEN 1 ELSE 0 END) AS BIGINT) AS breach_count, COUNT(*) AS batch_count,
       {r('100.0 * SUM(CASE WHEN sla_breach_flag THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE)', 2)} AS breach_percentage,
       sla_threshold_ms
FROM sla WHERE environment = 'prod' AND {lookback_days(AS_OF_END, None)} AND latency_ms IS NOT NULL
GROUP BY 1, 2, sla_threshold_ms""")

ORACLE["latency_rollup_range"] = with_(["sla"], f"""
SELECT query_name, COUNT(*) AS batch_count, CAST(SUM(CASE WHEN sla_breach_flag THEN 1 ELSE 0 END) AS BIGINT) AS breach_count,
       MAX(latency_ms) AS max_latency_ms, true AS p50_within_bound, true AS p90_within_bound, true AS p99_within_bound
FROM sla WHERE environment = 'prod' AND {lookback_days(AS_OF_END, None)} AND latency_ms IS NOT NULL
GROUP BY 1""")

SLICE = f"CAST(floor((epoch_us(ts) - {EPOCH_US}) / 864000000000) AS BIGINT)"

ORACLE["schema_changes"] = f"""
WITH s AS (SELECT {SLICE} AS k, COUNT(*) AS n FROM events GROUP BY 1),
p(path, type, since, until, kind) AS (VALUES
  ('$.sensor_id', 'STRING', 0, 1000, ''), ('$.temperature', 'NUMBER', 0, 1000, ''), ('$.pressure', 'NUMBER', 0, 1000, ''),
  ('$.event_time', 'STRING', 0, 1000, ''), ('$.region', 'STRING', 0, 1000, ''), ('$.facility', 'STRING', 0, 1000, ''),
  ('$.humidity', 'NUMBER', 0, 0, ''), ('$.humidity', 'STRING', 1, 1000, 'NEW TYPE'),
  ('$.firmware', 'OBJECT', 1, 1000, 'NEW FIELD'), ('$.firmware.channel', 'STRING', 1, 1000, 'NEW FIELD'),
  ('$.firmware.build', 'NUMBER', 2, 1000, 'NEW FIELD'))
SELECT k AS batch_id, path, type, n AS row_count, CASE WHEN k = 0 THEN 'INITIAL' WHEN k = since THEN kind ELSE 'KNOWN' END AS change
FROM s JOIN p ON k >= since AND k <= until"""

ORACLE["evolving_ingest"] = f"""
SELECT CAST(ts AS DATE) AS day, event_type AS region, COUNT(*) AS record_count,
       COUNT(CASE WHEN k = 0 THEN 1 END) AS typed_humidity, COUNT(CASE WHEN k >= 1 THEN 1 END) AS rescued_humidity,
       COUNT(CASE WHEN k >= 1 THEN 1 END) AS rescued_channel, COUNT(CASE WHEN k >= 2 THEN 1 END) AS rescued_build,
       MAX(value) AS max_temperature, CAST(0 AS BIGINT) AS corrupt_lines
FROM (SELECT *, {SLICE} AS k FROM events) e GROUP BY 1, 2"""

ORACLE["late_fraction_stream"] = ORACLE["late_fraction"]

ORACLE["history_duplicates"] = f"""
WITH e AS (SELECT event_type, {SLICE} AS k, user_id, CAST(floor(value) AS BIGINT) AS v FROM events),
f AS (SELECT event_type, user_id, v, MIN(k) AS first_k FROM e GROUP BY 1, 2, 3),
x AS (SELECT e.*, f.first_k < e.k AS again FROM e JOIN f ON e.event_type = f.event_type AND e.user_id = f.user_id AND e.v = f.v),
g AS (SELECT event_type, k AS batch_id, COUNT(*) AS record_count, COUNT(DISTINCT (user_id, v)) AS distinct_estimate,
             COUNT(DISTINCT (user_id, v)) FILTER (WHERE again) AS repeated_estimate, COUNT(*) FILTER (WHERE again) AS n
      FROM x GROUP BY 1, 2)
SELECT event_type, batch_id, record_count, distinct_estimate, repeated_estimate,
       repeated_estimate > 0.05 * distinct_estimate AS confirmed,
       CASE WHEN repeated_estimate > 0.05 * distinct_estimate THEN n END AS repeated_rows FROM g"""

ORACLE["clustered_layout"] = with_(["sla"], """
SELECT query_name, COUNT(*) AS row_count, MIN(timestamp) AS first_ts, MAX(timestamp) AS last_ts,
       CAST(SUM(latency_ms) AS BIGINT) AS total_latency_ms, true AS fewer_files_by_time FROM sla GROUP BY 1""")
