"""Log lines and anomaly records derived from the ``events`` table.

The test tables hold no log text, so the derived views below turn every
``events`` row into one log line and one anomaly record.  Both derivations are
row-wise projections (no shuffle) and grow with ``events``.  The same
definitions exist as DuckDB SQL in :mod:`loglens.oracle`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import line_time, parse_lines


def _level(event_type: Column) -> Column:
    return (F.when(event_type == "error", "ERROR").when(event_type == "signup", "WARN")
             .when(event_type == "view", "DEBUG").otherwise("INFO"))


def _message_head(event_id: Column, event_type: Column) -> Column:
    k = event_id % 13
    return (F.when(k == 0, F.lit("Connection timeout after "))
             .when(k == 1, F.lit("Permission DENIED for user "))
             .when(k == 2, F.lit("Login failed code "))
             .when(k == 3, F.lit("Unhandled Exception id "))
             .when(k == 4, F.lit("Disk fail on node "))
             .when(k == 5, F.lit("I/O error at block "))
             .otherwise(F.concat(event_type, F.lit(" ok "))))


def raw_log_lines(events: DataFrame) -> DataFrame:
    """event_id, raw_log, source_file, collected_at — one line per event.
    Every 50th event becomes a short, unparseable line."""
    e = events
    sec = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    line = F.concat(sec.cast("string"), F.lit(" "), _level(F.col("event_type")),
                    F.lit(" svc-"), (F.col("user_id") % 8).cast("string"), F.lit(" "),
                    _message_head(F.col("event_id"), F.col("event_type")),
                    (F.col("user_id") % 20).cast("string"))
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 50 == 0,
               F.concat(F.lit("corrupt "), F.col("event_id").cast("string"))).otherwise(line).alias("raw_log"),
        F.concat(F.lit("app"), (F.col("user_id") % 4).cast("string"), F.lit(".log")).alias("source_file"),
        (sec + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 5).cast("decimal(18,6)"))).alias("collected_at"),
    )


def parsed_logs(events: DataFrame) -> DataFrame:
    """Parsed log rows (LOGS fields + event_id + typed ``event_ts``)."""
    lines = raw_log_lines(events)
    p = parse_lines(lines, "raw_log", keep=["event_id", "source_file", "collected_at"])
    return p.withColumn("event_ts", line_time(F.col("raw_log")))


def valid_logs(events: DataFrame) -> DataFrame:
    """Parsed rows with a valid event time (the good side of the quarantine split)."""
    return parsed_logs(events).where(F.col("event_ts").isNotNull())


def anomaly_records(events: DataFrame) -> DataFrame:
    """One anomaly record per event, in the three detector shapes plus 'other'.

    Shapes follow the detector outputs: forest (score, log_count), sequence
    (errors, threshold, counts), message (distances, counts).  Thresholds are
    missing for every fifth sequence record.
    """
    eid, v = F.col("event_id"), F.col("value")
    kind = eid % 4
    is_f, is_l, is_b = kind == 0, kind == 1, kind == 2
    d = lambda x: F.lit(x).cast("double")
    return events.select(
        eid.alias("anomaly_id"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("timestamp"),
        (v > 5).alias("is_anomaly"),
        F.when(is_f, "isolation_forest").when(is_l, "lstm").when(is_b, "bert").otherwise("other").alias("detector_type"),
        F.when(is_f, -v / d(500)).alias("anomaly_score"),
        F.when(is_l, v / d(100)).alias("mean_error"),
        F.when(is_l, v / d(50)).alias("max_error"),
        F.when(is_l & (eid % 5 != 0), d(0.5)).alias("threshold"),
        F.when(is_b, v / d(10)).alias("mean_distance"),
        F.when(is_b, v / d(5)).alias("max_distance"),
        F.when(is_l | is_b, (F.col("user_id") % 14).cast("bigint")).alias("anomaly_count"),
        F.when(is_l, F.lit(20).cast("bigint")).alias("total_sequences"),
        F.when(is_b, F.lit(20).cast("bigint")).alias("total_logs"),
        F.when(is_f | is_l, F.col("user_id")).alias("log_count"),
        F.when(is_f, 5).when(is_l, 30).otherwise(10).cast("bigint").alias("time_window_minutes"),
    )
