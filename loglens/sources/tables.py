"""Parquet table access and the time-range / lookup scans over them."""
from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import anomaly_records, parsed_logs, valid_logs


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, typed log rows derived from ``events``."""
    return valid_logs(read_table(spark, sf_dir, "events"))


def _event_bounds(events: DataFrame, as_of, minutes: int, after_minutes: int = 0) -> DataFrame:
    """Pre-filter ``events`` on the stored ``ts`` column with the bounds implied by
    a range on the derived (second-truncated) time: ``ts ∈ [lo, hi + 1 s)``.  This
    predicate reaches the Parquet scan (PushedFilters); the exact inclusive range is
    still applied to the derived column."""
    hi = _ts(as_of) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(after_minutes), F.lit(1))
    lo = _ts(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return events.where((F.col("ts") >= lo) & (F.col("ts") < hi))


def logs_in_range(spark: SparkSession, sf_dir: str, as_of, minutes: int, after_minutes: int = 0) -> DataFrame:
    ev = _event_bounds(read_table(spark, sf_dir, "events"), as_of, minutes, after_minutes)
    return time_range(valid_logs(ev), "event_ts", as_of, minutes, after_minutes)


#: Collection follows an event by less than this many seconds (see fixtures).
COLLECT_LAG_SECONDS = 5


def collected_in_range(spark: SparkSession, sf_dir: str, as_of, minutes: int) -> DataFrame:
    """Logs collected in ``[as_of - minutes, as_of]``; the bounds that follow for
    the stored event time reach the Parquet scan."""
    ev = read_table(spark, sf_dir, "events")
    hi = _ts(as_of) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    lo = _ts(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(COLLECT_LAG_SECONDS))
    return time_range(valid_logs(ev.where((F.col("ts") >= lo) & (F.col("ts") < hi))), "collected_at", as_of, minutes)


def anomalies_in_range(spark: SparkSession, sf_dir: str, as_of, minutes: int) -> DataFrame:
    ev = _event_bounds(read_table(spark, sf_dir, "events"), as_of, minutes)
    return time_range(anomaly_records(ev), "timestamp", as_of, minutes)


def all_parsed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_logs(read_table(spark, sf_dir, "events"))


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_records(read_table(spark, sf_dir, "events"))


def _ts(x) -> F.Column:
    if isinstance(x, F.Column):
        return x
    if isinstance(x, _dt.datetime):
        x = x.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(x).cast("timestamp_ntz")


def time_range(df: DataFrame, col: str, as_of, minutes: int, after_minutes: int = 0,
               partition_col: str | None = None) -> DataFrame:
    """Rows with ``col`` in ``[as_of - minutes, as_of + after_minutes]`` (both ends inclusive).

    The bounds are literals, so the predicate reaches the Parquet scan as a
    pushed filter; when the table is partitioned by date, ``partition_col``
    adds the matching date bounds for partition pruning.
    """
    hi = _ts(as_of) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(after_minutes))
    lo = _ts(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    out = df.where(F.col(col).between(lo, hi))
    if partition_col:
        out = out.where(F.col(partition_col).between(F.to_date(lo), F.to_date(hi)))
    return out


def recent_anomalies(anoms: DataFrame, as_of, minutes: int, limit: int = 100) -> DataFrame:
    """Anomalous records in the last ``minutes`` before ``as_of``, newest first, top ``limit``.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``limit`` and only those reach the final merge.
    """
    return (time_range(anoms, "timestamp", as_of, minutes)
            .where(F.col("is_anomaly"))
            .orderBy(F.col("timestamp").desc(), F.col("anomaly_id").asc())
            .limit(limit))


def lookup_by_id(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup (pushed down as an equality filter)."""
    return df.where(F.col(key) == F.lit(value))
