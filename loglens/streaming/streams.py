"""Structured Streaming wiring of the batch operators.

* ``ingest_query``       ``*.log`` directory → parse → logs / quarantine tables
                         (``foreachBatch``, each file read once; a batch writes
                         its own partitions, so a replay replaces them).
* ``window_count_stream`` sliding-window feature counts with a watermark
                         (append mode: a window is emitted once it is final).
* ``dedup_stream``       incident dedup keys kept only within the watermark
                         (``dropDuplicatesWithinWatermark``) — bounded state.
* ``cooldown_stream``    per-detector alert cooldown as keyed state
                         (``applyInPandasWithState``): rows wait for the
                         watermark and are then folded in time order.
* ``detection_query``    stored detectors over each new part of the log table.

Checkpoints belong under the shared folder named by ``spark.checkpoint.dir``
(see :func:`loglens.session.scratch_path`).
"""
from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.constants import COOLDOWN_SECONDS, CRITICAL_COOLDOWN_SECONDS
from ..functions.parse import from_zoned, zoned
from ..operators.features import feature_counts, time_windows, window_feature_names
from ..plans import lifecycle
from ..plans.incidents import dedup_key
from ..sources.ingest import parse_log_frame, read_log_files, write_batch, write_log_tables


def ingest_query(spark: SparkSession, log_dir: str, logs_path: str, quarantine_path: str,
                 checkpoint: str, trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """Start the ingest stream; ``trigger`` e.g. {'processingTime': '10 seconds'}
    (the reference polls every 10 s) or {'availableNow': True}."""
    lines = read_log_files(spark, log_dir, stream=True, max_files_per_trigger=max_files_per_trigger)
    parsed = parse_log_frame(lines)
    w = (parsed.writeStream.foreachBatch(lambda b, i: write_log_tables(b, logs_path, quarantine_path, i))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.start()


def window_count_stream(logs: DataFrame, width: str = "5 minutes", slide: str = "30 seconds",
                        watermark: str = "1 minute", ts: str = "event_ts") -> DataFrame:
    """Streaming (window_start, feature, n) counts; rows later than the
    watermark are dropped from the stream (they still land in the log table)."""
    wm = logs.withColumn("_wm_ts", zoned(F.col(ts))).withWatermark("_wm_ts", watermark)
    win = F.window(F.col("_wm_ts"), width, slide)
    return (wm.select(win.alias("w"), F.explode(window_feature_names(ts=ts)).alias("feature"))
              .groupBy("w", "feature").agg(F.count(F.lit(1)).alias("n"))
              .select(from_zoned(F.col("w.start")).alias("window_start"), "feature", "n"))


def dedup_stream(anomalies: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """First arrival per dedup key, state kept for the watermark delay only."""
    a = anomalies.where(F.col("is_anomaly")).withColumn("dedup_key", dedup_key(anomalies))
    a = a.withColumn("_wm_ts", zoned(F.col("timestamp")))
    return a.withWatermark("_wm_ts", watermark).dropDuplicatesWithinWatermark(["dedup_key"]).drop("_wm_ts")


def cooldown_stream(evaluated: DataFrame, gap: float = COOLDOWN_SECONDS,
                    critical_gap: float = CRITICAL_COOLDOWN_SECONDS, watermark: str = "5 minutes") -> DataFrame:
    """Input: anomaly rows with ``severity``; output: (anomaly_id, detector_type, severity, sent).

    Rows wait in the detector's state until the watermark has passed them and are
    then folded in (time, id) order, so the decisions equal the batch operator's
    for any arrival order within the watermark; rows later than it are dropped.
    State per detector: the last sent time and the rows not yet passed, at most
    those of one watermark delay.  Rows without a time are never decided.
    """
    rows = (evaluated.select("anomaly_id", "detector_type", "severity", zoned(F.col("timestamp")).alias("at"))
            .withWatermark("at", watermark)
            .select("anomaly_id", "detector_type", "severity", "at", F.unix_millis("at").alias("ms")))

    def fold(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        last, ids, severities, times = state.get if state.exists else (None, [], [], [])
        held = list(zip(times, ids, severities))
        if not state.hasTimedOut:
            for pdf in pdfs:
                held += zip(pdf["ms"].tolist(), pdf["anomaly_id"].tolist(), pdf["severity"].tolist())
        passed = state.getCurrentWatermarkMs()
        ready = sorted((r for r in held if r[0] <= passed), key=lambda r: r[:2])
        held = [r for r in held if r[0] > passed]
        out = []
        for ms, anomaly_id, severity in ready:
            need = 1000 * (critical_gap if severity == "critical" else gap)
            sent = severity != "low" and (last is None or ms - last >= need)
            if sent:
                last = ms
            out.append((anomaly_id, key[0], severity, sent))
        state.update((last, [r[1] for r in held], [r[2] for r in held], [r[0] for r in held]))
        if held:
            state.setTimeoutTimestamp(max(min(r[0] for r in held) - 1, passed + 1))
        yield pd.DataFrame(out, columns=["anomaly_id", "detector_type", "severity", "sent"])

    return rows.groupBy("detector_type").applyInPandasWithState(
        fold, "anomaly_id long, detector_type string, severity string, sent boolean",
        "last long, ids array<long>, severities array<string>, times array<long>",
        "append", GroupStateTimeout.EventTimeTimeout)


def detection_query(spark: SparkSession, logs_path: str, model_root: str, anomalies_path: str, checkpoint: str,
                    trigger: dict | None = None):
    """Start the detectors over a growing log table: each micro-batch of new rows
    sets the time ``as_of`` (its latest collection time), and every detector with a
    stored model scans its own window of the table up to it.  Records are written
    by batch, so a replay replaces them."""
    def run(batch: DataFrame, batch_id: int) -> None:
        as_of = batch.agg(F.max("collected_at")).first()[0]
        if as_of is None:
            return
        session = batch.sparkSession
        records = lifecycle.detect_all(session.read.parquet(logs_path), model_root, as_of)
        write_batch(records.withColumn("dt", F.to_date("timestamp")), anomalies_path, batch_id)

    schema = spark.read.parquet(logs_path).schema
    return (spark.readStream.schema(schema).parquet(logs_path).writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start())
