"""Sliding sequences over per-minute feature vectors, and forecast errors.

A series is one ``series_key`` (e.g. source file); its rows are the minutes
that have logs (minutes without logs are absent, not zero).  Sequence ``t``
takes the previous ``seq_length`` rows as input and row ``t`` as target, so a
series of ``n`` rows gives ``n - seq_length`` sequences.

Scale note: the window is partitioned by series and ordered by minute; its
input is the *aggregated* minute series (one row per minute per series), so a
series that receives a third of all logs is still only 1 440 rows per day.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import SEQ_LENGTH, THRESHOLD_PERCENTILE, VALIDATION_SPLIT
from . import features as FT


def scaled_minute_vectors(cells: DataFrame, vocab: DataFrame, stats: DataFrame | None = None,
                          series: str = "series_key", minute: str = "minute") -> DataFrame:
    """Min-max scale long minute cells per series and pivot to dense vectors."""
    if stats is None:
        stats = FT.minmax_stats(cells, [minute], group_keys=[series])
    scaled = FT.apply_scaler(cells, stats, "min", "range", group_keys=[series])
    return FT.dense_vectors(scaled, vocab, [series, minute], value_col="scaled")


def sequences(vectors: DataFrame, seq_length: int = SEQ_LENGTH, series: str = "series_key",
              order: str = "minute", vec: str = "vec") -> DataFrame:
    """(series, order, x array<array<double>>, y array<double>, seq_idx, n_seq)."""
    w = Window.partitionBy(series).orderBy(order)
    frame = w.rowsBetween(-seq_length, -1)
    out = (vectors.select(series, order, F.collect_list(vec).over(frame).alias("x"), F.col(vec).alias("y"),
                          (F.row_number().over(w) - seq_length - 1).alias("seq_idx"),
                          (F.count(F.lit(1)).over(Window.partitionBy(series)) - seq_length).alias("n_seq"))
                  .where(F.size("x") == seq_length))
    return out


def last_steps(vectors: DataFrame, seq_length: int = SEQ_LENGTH, series: str = "series_key",
               order: str = "minute", vec: str = "vec") -> DataFrame:
    """(series, order, prev, y, seq_idx, n_seq): the sequences of :func:`sequences`
    with only the last row of their input, for forecasters that need no more."""
    w = Window.partitionBy(series).orderBy(order)
    return (vectors.select(series, order, F.lag(vec).over(w).alias("prev"), F.col(vec).alias("y"),
                           (F.row_number().over(w) - seq_length - 1).alias("seq_idx"),
                           (F.count(F.lit(1)).over(Window.partitionBy(series)) - seq_length).alias("n_seq"))
                   .where(F.col("seq_idx") >= 0))


def chrono_split(seqs: DataFrame, validation_split: float = VALIDATION_SPLIT) -> Column:
    """'train' for the first floor(n * (1 - split)) sequences of a series, else 'validation'."""
    cut = F.floor(F.col("n_seq") * F.lit(1.0 - validation_split))
    return F.when(F.col("seq_idx") < cut, "train").otherwise("validation")


def mean_abs_error(pred: Column, actual: Column) -> Column:
    diffs = F.zip_with(pred, actual, lambda a, b: F.abs(a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v) / F.size(actual)


def squared_error_mean(pred: Column, actual: Column) -> Column:
    diffs = F.zip_with(pred, actual, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v) / F.size(actual)


def error_summary(errors: DataFrame, series: str = "series_key", err: str = "error",
                  q: float = THRESHOLD_PERCENTILE, threshold: DataFrame | None = None) -> DataFrame:
    """Per series: exact p{q} threshold (linear interpolation), max, mean, anomaly
    count (error > threshold, strict), total sequences, any-anomaly flag.

    ``percentile`` is exact; it keeps a value→count map per series, bounded by
    the distinct errors of that series (minutes), not by log volume.
    """
    if threshold is None:
        threshold = errors.groupBy(series).agg(F.percentile(F.col(err), q).alias("threshold"))
    j = errors.join(threshold, series, "inner")
    return j.groupBy(series).agg(
        F.max(err).alias("max_error"), F.avg(err).alias("mean_error"),
        F.first("threshold").alias("threshold"),
        F.sum(F.when(F.col(err) > F.col("threshold"), 1).otherwise(0)).cast("bigint").alias("anomaly_count"),
        F.count(F.lit(1)).alias("total_sequences"),
        F.bool_or(F.col(err) > F.col("threshold")).alias("is_anomaly"))
