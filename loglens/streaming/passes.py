"""Running passes over growing tables: incidents, alerts, workflow outcomes, windows.

Each pass is a streaming query whose results equal the batch operators' on all
rows seen so far.

* ``incident_query``  anomaly records → incidents.  ``foreachBatch`` anti-joins a
  table of processed keys, so overlapping polls give each incident once; both
  tables are written by batch id, so a replayed batch replaces its own rows.
* ``alert_stream``    anomaly records → sent alerts.  ``transformWithState`` holds, per
  detector, a map from second and class to the first anomaly, and a timer per
  second; when the watermark passes a second it is decided and forgotten.
* ``alert_query``     anomaly records → outbox.  Each batch of sent alerts finds its
  records in the anomaly table, within the seconds at hand, and is written by batch id.
* ``outcome_stream``  workflow requests and results, joined outer under
  watermarks; a request without a result in time becomes an error.
* ``window_query``    logs → sliding window counts.  Rows are counted once, per pane
  (the slide); windows are sums of panes.  Every batch, late rows included,
  recounts just the windows that its panes touch and writes them as a new
  version; readers take the latest version of a window.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import constants as C
from ..functions.parse import zoned
from ..functions.severity import severity
from ..operators.features import from_panes, pane_counts
from ..plans import alerts as AL
from ..plans import incidents as IN
from ..session import checkpointed, ship_package
from ..sources.ingest import stored_rows, write_batch


def _bounds(df: DataFrame, col: str) -> tuple:
    """Least and largest value of a column (one row)."""
    return tuple(df.agg(F.min(col), F.max(col)).first())


# ---------------------------------------------------------------- incidents

def unprocessed(deduped: DataFrame, keys: DataFrame | None, batch_id: int) -> DataFrame:
    """Records (with ``dedup_key``, ``dt``) whose key no other batch has processed.  A
    key holds its record's time, so only the days at hand are read."""
    if keys is None:
        return deduped
    first, last = _bounds(deduped, "dt")
    known = keys.where((F.col("batch") != batch_id) & (F.col("dt").isNull() if first is None else F.col("dt").between(F.lit(first), F.lit(last)) | F.col("dt").isNull()))
    return deduped.join(known.select("dedup_key"), "dedup_key", "left_anti")


def incident_pass(batch: DataFrame, batch_id: int, logs: Callable[[SparkSession], DataFrame], root: str) -> None:
    """One batch of anomaly records: new keys become incidents with context, low
    severities only a processed key.  ``<root>/incidents`` is written before
    ``<root>/keys``: a batch that fails in between is run again as a whole."""
    spark = batch.sparkSession
    records = batch.withColumn("dedup_key", IN.dedup_key(batch))
    first = IN.dedup_anomalies(records).withColumn("dt", F.to_date("timestamp"))
    fresh = checkpointed(unprocessed(first, stored_rows(spark, f"{root}/keys"), batch_id))
    new = checkpointed(IN.build_incidents(fresh.drop("dedup_key", "dt")))
    lo, hi = _bounds(new, "timestamp")
    near = logs(spark)
    if lo is not None:      # literal bounds reach the scan
        near = near.where((F.col("event_ts") >= F.lit(lo) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(C.RELATED_BEFORE_MINUTES)))
                          & (F.col("event_ts") <= F.lit(hi) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(C.RELATED_AFTER_MINUTES))))
    numbered: list[DataFrame] = []      # read for the counts and for the samples
    related = IN.related_positions(new, near, keep=lambda df: numbered.append(df.persist()) or df, cut=checkpointed)
    try:
        enriched = IN.enrich(new, IN.context(related))
        write_batch(enriched.withColumn("dt", F.to_date("timestamp")), f"{root}/incidents", batch_id)
        write_batch(fresh.select("dedup_key", "severity", "dt"), f"{root}/keys", batch_id)
    finally:
        for df in numbered:
            df.unpersist()


def incident_query(anomalies: DataFrame, logs: Callable[[SparkSession], DataFrame], root: str, checkpoint: str, trigger: dict | None = None):
    """Start the incident pass over a stream of anomaly records; ``logs`` gives the
    log table as it is when a batch runs."""
    return (anomalies.writeStream.foreachBatch(lambda b, i: incident_pass(b, i, logs, root))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "60 seconds"})).start())


# ------------------------------------------------------------------- alerts

class Cooldown(StatefulProcessor):
    """Cooldown of one detector.  State: the last sent second, and for every second
    the watermark hasn't passed the first anomaly of each class (critical or not):
    of the alerts of one second and class only the first can be sent."""

    def __init__(self, gap: float, critical_gap: float):
        self.gap, self.critical_gap = gap, critical_gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "second long")
        self.waiting = handle.getMapState("waiting", "second long, critical boolean", "anomaly_id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            firsts = pdf.groupby(["second", "critical"])["anomaly_id"].min()
            for (second, critical), anomaly_id in firsts.items():
                at = (int(second), bool(critical))
                if self.waiting.containsKey(at):
                    anomaly_id = min(int(anomaly_id), int(self.waiting.getValue(at)[0]))
                self.waiting.updateValue(at, (int(anomaly_id),))
                self.handle.registerTimer(int(second) * 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        ready = sorted((int(k[0]), int(v[0]), bool(k[1])) for k, v in list(self.waiting.iterator()) if int(k[0]) * 1000 <= passed)
        last = int(self.last.get()[0]) if self.last.exists() else None
        out = []
        for second, anomaly_id, critical in ready:
            self.waiting.removeKey((second, critical))
            if last is None or second - last >= (self.critical_gap if critical else self.gap):
                last = second
                out.append((anomaly_id, key[0], "critical" if critical else "other", second))
        if out:
            self.last.update((last,))
            yield pd.DataFrame(out, columns=["anomaly_id", "detector_type", "class", "second"])

    def close(self) -> None:
        pass


#: transformWithState needs this state store; set it before the query starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def alert_stream(anomalies: DataFrame, gap: float = C.COOLDOWN_SECONDS, critical_gap: float = C.CRITICAL_COOLDOWN_SECONDS,
                 watermark: str = "5 minutes") -> DataFrame:
    """(anomaly_id, detector_type, class, second) of the alerts to send, as the batch
    cooldown decides them, for any order of arrival within the watermark.  Rows
    behind it, and rows without a time, raise no alert."""
    ship_package(anomalies.sparkSession)
    graded = anomalies.where(F.col("is_anomaly")).withColumn("severity", severity()).where("severity <> 'low'")
    at = zoned(F.col("timestamp"))
    rows = (graded.select("anomaly_id", "detector_type", (F.col("severity") == "critical").alias("critical"), at.alias("at"))
            .withWatermark("at", watermark).withColumn("second", F.unix_seconds("at")))
    return rows.groupBy("detector_type").transformWithStateInPandas(
        statefulProcessor=Cooldown(gap, critical_gap), outputStructType="anomaly_id long, detector_type string, class string, second long",
        outputMode="Append", timeMode="EventTime")


def alert_pass(sent: DataFrame, batch_id: int, records: Callable[[SparkSession], DataFrame], root: str) -> None:
    """One batch of sent alerts: their records become rows of ``<root>/alerts``, one
    per channel with message and payload.  A batch without alerts writes nothing;
    a replayed one replaces its rows.  Copies of a record give one alert."""
    spark = sent.sparkSession
    sent = sent.select("anomaly_id", "detector_type", "second").persist()
    try:
        first, last = _bounds(sent, "second")
        if first is None:
            return
        bound = lambda second: F.lit(str(datetime(1970, 1, 1) + timedelta(seconds=second))).cast("timestamp_ntz")
        near = records(spark).where((F.col("timestamp") >= bound(first)) & (F.col("timestamp") < bound(last + 1)) & F.col("is_anomaly"))
        rows = near.join(sent.select("anomaly_id", "detector_type").distinct(), ["anomaly_id", "detector_type"], "left_semi")
        rows = rows.dropDuplicates(["anomaly_id", "detector_type"]).withColumn("severity", severity()).withColumn("sent", F.lit(True))
        write_batch(AL.alert_outbox(rows).withColumn("dt", F.to_date("sent_at")), f"{root}/alerts", batch_id)
    finally:
        sent.unpersist()


def alert_query(anomalies: DataFrame, records: Callable[[SparkSession], DataFrame], root: str, checkpoint: str,
                trigger: dict | None = None, **cooldown):
    """Start the alert pass over a stream of anomaly records; ``records`` gives the
    anomaly table as it is when a batch runs, ``cooldown`` goes to :func:`alert_stream`."""
    return (alert_stream(anomalies, **cooldown).writeStream.foreachBatch(lambda b, i: alert_pass(b, i, records, root)).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "60 seconds"})).start())


# ---------------------------------------------------------- workflow outcomes

def outcome_stream(requests: DataFrame, results: DataFrame, within: str = "10 minutes", watermark: str = "1 minute") -> DataFrame:
    """Outcomes (see :func:`incidents.workflow_results`) of streamed requests and
    results; a request's error is known once both watermarks have passed its time."""
    late = lambda df, col: df.withColumn(col, zoned(F.col(col))).withWatermark(col, watermark)
    return IN.workflow_results(late(requests, "requested_at"), late(results, "result_at"), within, zoned_times=True)


# ------------------------------------------------------------------ windows

def window_pass(batch: DataFrame, batch_id: int, root: str, width: str, slide: str, ts: str) -> None:
    """One batch of log rows: its panes, then the windows those panes touch."""
    spark = batch.sparkSession
    panes = pane_counts(batch.where(F.col(ts).isNotNull()), slide, ts).withColumn("dt", F.to_date("pane")).persist()
    try:
        write_batch(panes, f"{root}/panes", batch_id)
        lo, hi = _bounds(panes, "pane")
        if lo is None:
            return
        touched = from_panes(panes, width, slide).select("window_start").distinct()
        span = F.expr(f"INTERVAL {width}")
        # other batches' panes only: a replay must count what its own rows are now
        near = spark.read.parquet(f"{root}/panes").where(
            F.col("dt").between(F.to_date(F.lit(lo) - span), F.to_date(F.lit(hi) + span)) & (F.col("batch") < batch_id)
            & F.col("pane").between(F.lit(lo) - span, F.lit(hi) + span))
        cols = ["pane", "feature", "n"]
        counts = from_panes(near.select(*cols).unionByName(panes.select(*cols)), width, slide).join(touched, "window_start", "left_semi")
        write_batch(counts.withColumn("dt", F.to_date("window_start")), f"{root}/windows", batch_id)
    finally:
        panes.unpersist()


def window_query(logs: DataFrame, root: str, checkpoint: str, width: str = "5 minutes", slide: str = "30 seconds",
                 ts: str = "collected_at", trigger: dict | None = None):
    """Start the window counts over a stream of log rows."""
    return (logs.writeStream.foreachBatch(lambda b, i: window_pass(b, i, root, width, slide, ts))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def latest_windows(spark: SparkSession, root: str) -> DataFrame:
    """(window_start, feature, n) by the latest version of each window."""
    w = spark.read.parquet(f"{root}/windows")
    return w.groupBy("window_start", "feature").agg(F.max_by("n", "batch").alias("n"))
