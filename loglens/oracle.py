"""DuckDB SQL for the derived views, shared by the oracle queries.

These mirror :mod:`loglens.sources.fixtures` and :mod:`loglens.functions.parse`
so that each Spark query can be checked against an independent SQL engine.
"""

RAW_LOGS = """
raw_logs AS (
  SELECT event_id,
    CASE WHEN event_id % 50 = 0 THEN 'corrupt ' || CAST(event_id AS VARCHAR)
    ELSE CAST(date_trunc('second', ts) AS VARCHAR) || ' ' ||
      CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN'
                      WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END
      || ' svc-' || CAST(user_id % 8 AS VARCHAR) || ' ' ||
      CASE event_id % 13 WHEN 0 THEN 'Connection timeout after ' WHEN 1 THEN 'Permission DENIED for user '
        WHEN 2 THEN 'Login failed code ' WHEN 3 THEN 'Unhandled Exception id '
        WHEN 4 THEN 'Disk fail on node ' WHEN 5 THEN 'I/O error at block '
        ELSE event_type || ' ok ' END
      || CAST(user_id % 20 AS VARCHAR) END AS raw_log,
    'app' || CAST(user_id % 4 AS VARCHAR) || '.log' AS source_file,
    date_trunc('second', ts) + to_seconds(event_id % 5) AS collected_at
  FROM events
)"""

PARSED = RAW_LOGS + """,
split_logs AS (
  SELECT event_id, source_file, collected_at,
         regexp_replace(raw_log, '^\\s+|\\s+$', '', 'g') AS s,
         string_split(regexp_replace(raw_log, '^\\s+|\\s+$', '', 'g'), ' ') AS a
  FROM raw_logs
  WHERE length(regexp_replace(raw_log, '^\\s+|\\s+$', '', 'g')) > 0
),
parsed_logs AS (
  SELECT event_id, source_file, collected_at,
    CASE WHEN len(a) >= 4 THEN a[1] || ' ' || a[2] END AS timestamp,
    CASE WHEN len(a) >= 4 THEN a[3] END AS log_level,
    CASE WHEN len(a) >= 4 THEN a[4] END AS component,
    CASE WHEN len(a) >= 4 THEN array_to_string(a[5:], ' ') END AS message,
    s AS raw_log,
    CASE WHEN len(a) < 4 THEN 'list index out of range' END AS parse_error,
    try_strptime(CASE WHEN len(a) >= 4 THEN a[1] || ' ' || a[2] END, '%Y-%m-%d %H:%M:%S') AS event_ts
  FROM split_logs
)"""

LOGS = PARSED + """,
logs AS (SELECT * FROM parsed_logs WHERE event_ts IS NOT NULL)"""

ANOMALIES = """
anomalies AS (
  SELECT event_id AS anomaly_id, date_trunc('second', ts) AS timestamp,
    value > 5 AS is_anomaly,
    CASE event_id % 4 WHEN 0 THEN 'isolation_forest' WHEN 1 THEN 'lstm' WHEN 2 THEN 'bert' ELSE 'other' END AS detector_type,
    CASE WHEN event_id % 4 = 0 THEN -value / CAST(500 AS DOUBLE) END AS anomaly_score,
    CASE WHEN event_id % 4 = 1 THEN value / CAST(100 AS DOUBLE) END AS mean_error,
    CASE WHEN event_id % 4 = 1 THEN value / CAST(50 AS DOUBLE) END AS max_error,
    CASE WHEN event_id % 4 = 1 AND event_id % 5 <> 0 THEN CAST(0.5 AS DOUBLE) END AS threshold,
    CASE WHEN event_id % 4 = 2 THEN value / CAST(10 AS DOUBLE) END AS mean_distance,
    CASE WHEN event_id % 4 = 2 THEN value / CAST(5 AS DOUBLE) END AS max_distance,
    CASE WHEN event_id % 4 IN (1, 2) THEN CAST(user_id % 14 AS BIGINT) END AS anomaly_count,
    CASE WHEN event_id % 4 = 1 THEN CAST(20 AS BIGINT) END AS total_sequences,
    CASE WHEN event_id % 4 = 2 THEN CAST(20 AS BIGINT) END AS total_logs,
    CASE WHEN event_id % 4 IN (0, 1) THEN user_id END AS log_count,
    CAST(CASE event_id % 4 WHEN 0 THEN 5 WHEN 1 THEN 30 ELSE 10 END AS BIGINT) AS time_window_minutes
  FROM events
)"""

SEVERITY_CASE = """
CASE
  WHEN detector_type = 'isolation_forest' THEN
    CASE WHEN coalesce(anomaly_score, 0.0) < -0.7 THEN 'critical'
         WHEN coalesce(anomaly_score, 0.0) < -0.5 THEN 'high'
         WHEN coalesce(anomaly_score, 0.0) < -0.3 THEN 'medium' ELSE 'low' END
  WHEN detector_type = 'lstm' THEN
    CASE WHEN coalesce(CASE WHEN threshold IS NULL THEN 0.0 WHEN threshold = 0 THEN NULL ELSE coalesce(mean_error, 0.0) / threshold END > 2.0, false)
              OR coalesce(anomaly_count, 0) / greatest(coalesce(total_sequences, 1), 1)::DOUBLE > 0.5 THEN 'critical'
         WHEN coalesce(CASE WHEN threshold IS NULL THEN 0.0 WHEN threshold = 0 THEN NULL ELSE coalesce(mean_error, 0.0) / threshold END > 1.5, false)
              OR coalesce(anomaly_count, 0) / greatest(coalesce(total_sequences, 1), 1)::DOUBLE > 0.3 THEN 'high'
         WHEN coalesce(CASE WHEN threshold IS NULL THEN 0.0 WHEN threshold = 0 THEN NULL ELSE coalesce(mean_error, 0.0) / threshold END > 1.2, false)
              OR coalesce(anomaly_count, 0) / greatest(coalesce(total_sequences, 1), 1)::DOUBLE > 0.1 THEN 'medium'
         ELSE 'low' END
  WHEN detector_type = 'bert' THEN
    CASE WHEN coalesce(anomaly_count, 0) / greatest(coalesce(total_logs, 1), 1)::DOUBLE > 0.5 THEN 'critical'
         WHEN coalesce(anomaly_count, 0) / greatest(coalesce(total_logs, 1), 1)::DOUBLE > 0.3 THEN 'high'
         WHEN coalesce(anomaly_count, 0) / greatest(coalesce(total_logs, 1), 1)::DOUBLE > 0.1 THEN 'medium'
         ELSE 'low' END
  ELSE 'medium'
END"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes)
