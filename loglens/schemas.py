"""Explicit schemas of the tables this package reads and writes."""
from pyspark.sql import types as T

LOGS = T.StructType([
    T.StructField("timestamp", T.StringType()),        # text as parsed
    T.StructField("log_level", T.StringType()),
    T.StructField("component", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("raw_log", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("collected_at", T.TimestampNTZType()),
    T.StructField("parse_error", T.StringType()),
])

# Typed log table: LOGS plus the event time cast to a timestamp and a date partition.
LOG_TABLE = T.StructType(LOGS.fields + [
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("dt", T.DateType()),
])

CLUSTER_STAT = T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("anomaly_count", T.LongType()),
    T.StructField("anomaly_ratio", T.DoubleType()),
])

ANOMALIES = T.StructType([
    T.StructField("anomaly_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("detector_type", T.StringType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("time_window_minutes", T.LongType()),
    T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("log_count", T.LongType()),
    T.StructField("max_error", T.DoubleType()),
    T.StructField("mean_error", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("anomaly_count", T.LongType()),
    T.StructField("total_sequences", T.LongType()),
    T.StructField("max_distance", T.DoubleType()),
    T.StructField("mean_distance", T.DoubleType()),
    T.StructField("total_logs", T.LongType()),
    T.StructField("cluster_stats", T.MapType(T.StringType(), CLUSTER_STAT)),
])

ACTION = T.StructType([
    T.StructField("action_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

LOG_SAMPLE = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("log_level", T.StringType()),
    T.StructField("component", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("source_file", T.StringType()),
])

CONTEXT = T.StructType([
    T.StructField("related_logs_count", T.LongType()),
    T.StructField("log_level_stats", T.MapType(T.StringType(), T.LongType())),
    T.StructField("component_stats", T.MapType(T.StringType(), T.LongType())),
    T.StructField("log_samples", T.ArrayType(LOG_SAMPLE)),
])

INCIDENTS = T.StructType([
    T.StructField("incident_id", T.StringType()),
    T.StructField("anomaly_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("detector_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("context", CONTEXT),
    T.StructField("actions", T.ArrayType(ACTION)),
])

DETAIL = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("value", T.StringType()),
])

ALERTS = T.StructType([
    T.StructField("anomaly_id", T.LongType()),
    T.StructField("detector_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("details", T.ArrayType(DETAIL)),
    T.StructField("channel", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("sent_at", T.TimestampNTZType()),
])

INCIDENT_EVENTS = T.StructType([
    T.StructField("incident_id", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("action", ACTION),
])
