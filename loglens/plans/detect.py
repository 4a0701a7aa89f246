"""Detector outputs → one anomaly table.

Each detector writes its own record shape; the anomaly table is their union
by column name (missing fields null).  Appends are partitioned by day.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ANOMALIES

FOREST_FIELDS = ["anomaly_id", "timestamp", "detector_type", "is_anomaly", "anomaly_score",
                 "log_count", "time_window_minutes"]
LSTM_FIELDS = ["anomaly_id", "timestamp", "detector_type", "is_anomaly", "max_error", "mean_error",
               "threshold", "anomaly_count", "total_sequences", "log_count", "time_window_minutes"]
BERT_FIELDS = ["anomaly_id", "timestamp", "detector_type", "is_anomaly", "max_distance",
               "mean_distance", "anomaly_count", "total_logs", "time_window_minutes", "cluster_stats"]


def conform(df: DataFrame) -> DataFrame:
    """Project any detector output onto the ANOMALIES schema (missing → null)."""
    cols = []
    for f in ANOMALIES.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_detector_outputs(*outputs: DataFrame) -> DataFrame:
    """Union of differently shaped detector outputs by column name."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outputs)
    return conform(merged)


def append_anomalies(df: DataFrame, path: str) -> None:
    """Append to the anomaly table, partitioned by day of the record time."""
    (conform(df).withColumn("dt", F.to_date("timestamp"))
     .write.mode("append").partitionBy("dt").parquet(path))
