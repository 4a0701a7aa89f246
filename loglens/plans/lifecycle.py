"""Detector life cycle: ``train_*`` stores a model version, ``detect_*`` loads the
latest one and scores the logs collected up to a time.

Training and detection read the log table by collection time, inclusive at both
ends: the ``TRAIN_MINUTES`` before ``as_of`` for a fit, each detector's own window
for detection.  Whatever detection needs is stored (``loglens.models``): trees,
vocabulary, scalers, coefficients, thresholds, centroids, cluster profiles, the
text encoder.  Records carry a stable id (hash of detector, unit and time).

Defined results: a training range without usable rows, or logs without a column
the detector reads (``COLUMNS``), store nothing (``None``); detection on a range
without usable rows writes no record, raises ``FileNotFoundError`` without a stored
model and ``ValueError`` without a column (``detect_all`` skips that detector);
features, series and values unseen in training are dropped, absent ones are 0.

Scale: the fits are the operators' distributed aggregates; vocabulary and scalers
are tables.  What the driver holds is model-sized (trees, coefficients), never
rows of logs.
"""
from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import models as M
from ..functions.constants import KMEANS_K
from ..functions.parse import epoch_seconds
from ..operators import clustering as CL
from ..operators import embedding as EM
from ..operators import features as FT
from ..operators import forecast as FC
from ..operators import forest as FO
from ..operators import sequences as SQ
from ..operators import sparse as SP
from ..sources.tables import time_range
from .detect import conform, union_detector_outputs

TRAIN_MINUTES = 1440
#: Detection windows, in minutes.
FOREST_MINUTES, SEQUENCE_MINUTES, MESSAGE_MINUTES = 5, 30, 10
FOREST, SEQUENCE, MESSAGE = "isolation_forest", "lstm", "bert"
#: Columns that each detector reads.
COLUMNS = {FOREST: ("collected_at", "event_ts", "log_level", "component", "message"),
           SEQUENCE: ("collected_at", "event_ts", "log_level", "component", "message", "source_file"),
           MESSAGE: ("collected_at", "message")}
#: Age from which a model is trained anew.
RETRAIN_HOURS = 24


def missing_columns(logs: DataFrame, detector: str) -> list[str]:
    return [c for c in COLUMNS[detector] if c not in logs.columns]


def _need(logs: DataFrame, detector: str) -> None:
    gone = missing_columns(logs, detector)
    if gone:
        raise ValueError(f"{detector} reads columns that the logs don't have: {', '.join(gone)}")


def collected(logs: DataFrame, as_of, minutes: int) -> DataFrame:
    """Logs of a range of collection time; of a table by day only those days are read."""
    return time_range(logs, "collected_at", as_of, minutes, partition_col="dt" if "dt" in logs.columns else None)


def _at(as_of) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def _record_id(detector: str, *unit: Column) -> Column:
    return F.xxhash64(F.lit(detector), *unit)


def _next_version(logs: DataFrame, root: str, detector: str) -> int:
    return (M.latest_version(logs.sparkSession, root, detector) or 0) + 1


# ---------------------------------------------------------------- window forest

def _windows(logs: DataFrame, as_of, span: int, minutes: int) -> Column:
    """End of the ``minutes``-wide window, counted back from ``as_of``, that holds
    a row; the oldest window of the span includes its lower end."""
    back = F.floor((epoch_seconds(_at(as_of)) - epoch_seconds(F.col("collected_at"))) / (60 * minutes))
    back = F.least(back, F.lit(max(-(-span // minutes) - 1, 0)).cast("long"))
    return _at(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), (back * minutes).cast("int"))


def _vectors(cells: DataFrame, vocab: DataFrame) -> DataFrame:
    """Every bucket's vector, all zero where each of its features is unseen."""
    rows = cells.select("bucket").distinct().join(FT.sparse_vectors(cells, vocab, ["bucket"]), "bucket", "left")
    return rows.select("bucket", FT.widened(F.col("cells"), vocab.count()).alias("vec"))


def train_forest(logs: DataFrame, root: str, as_of, minutes: int = TRAIN_MINUTES, width: int = FOREST_MINUTES) -> int | None:
    if missing_columns(logs, FOREST):
        return None
    spark = logs.sparkSession
    rows = collected(logs, as_of, minutes)
    cells = FT.feature_counts(rows, _windows(rows, as_of, minutes, width), FT.window_feature_names()).persist()
    vocab = FT.vocabulary(cells).persist()
    kept = [cells, vocab]
    try:
        if vocab.isEmpty():
            return None
        vecs = _vectors(cells, vocab)
        scaler = CL.fit_standardizer(vecs, "vec").join(vocab, "i").persist()
        x = CL.standardized(vecs, "vec", scaler, "x").select(F.col("bucket").cast("string").alias("key"), "x").persist()
        kept += [scaler, x]
        model = FO.fit_forest(x, "key", "x")
        offset = FO.fit_offset(FO.score_forest(x, "x", model))
        v = _next_version(logs, root, FOREST)
        M.save_tables(spark, root, FOREST, v, {"trees": M.forest_to_frame(spark, model), "scaler": scaler},
                      {"psi": model["psi"], "offset": offset, "width": width, "as_of": str(as_of)})
        return v
    finally:
        for df in kept:
            df.unpersist()


def detect_forest(logs: DataFrame, root: str, as_of, minutes: int = FOREST_MINUTES) -> DataFrame:
    """One record per window of the trained width that holds logs."""
    _need(logs, FOREST)
    meta, t = M.load_tables(logs.sparkSession, root, FOREST, ["trees", "scaler"])
    rows = collected(logs, as_of, minutes).withColumn("bucket", _windows(logs, as_of, minutes, meta["width"]))
    cells = FT.feature_counts(rows, F.col("bucket"), FT.window_feature_names())
    x = CL.standardized(_vectors(cells, t["scaler"]), "vec", t["scaler"], "x").select("bucket", "x")
    scored = FO.score_forest(x, "x", M.forest_from_frame(t["trees"], meta["psi"]))
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("log_count"))
    return conform(scored.join(counts, "bucket").select(
        _record_id(FOREST, F.col("bucket").cast("string")).alias("anomaly_id"), F.col("bucket").alias("timestamp"),
        F.lit(FOREST).alias("detector_type"), "anomaly_score", (F.col("anomaly_score") < F.lit(meta["offset"])).alias("is_anomaly"),
        "log_count", F.lit(meta["width"]).alias("time_window_minutes")))


# ---------------------------------------------------------------- minute sequences

def _minute_cells(rows: DataFrame) -> DataFrame:
    cells = FT.minute_features(rows.withColumn("series_key", F.col("source_file")), keys=["series_key"])
    return cells.withColumnRenamed("bucket", "minute")


def train_sequence(logs: DataFrame, root: str, as_of, minutes: int = TRAIN_MINUTES, solver: str = "gram") -> int | None:
    """``solver``: ``gram`` or ``gradients`` (see ``operators.forecast``)."""
    if missing_columns(logs, SEQUENCE):
        return None
    spark = logs.sparkSession
    cells = _minute_cells(collected(logs, as_of, minutes)).persist()
    vocab = FT.vocabulary(cells).persist()
    try:
        if vocab.isEmpty():
            return None
        stats = FT.minmax_stats(cells, ["minute"], group_keys=["series_key"]).persist()
        seqs = SQ.sequences(SQ.scaled_minute_vectors(cells, vocab, stats)).persist()
        if seqs.isEmpty():
            return None
        train = seqs.where(SQ.chrono_split(seqs) == "train")
        w = FC.SOLVERS[solver](seqs if train.isEmpty() else train)
        errors = FC.forecast_errors(seqs, w)
        thresholds = errors.groupBy("series_key").agg(F.percentile("error", 0.95).alias("threshold"))
        v = _next_version(logs, root, SEQUENCE)
        M.save_tables(spark, root, SEQUENCE, v, {
            "vocab": vocab, "scaler": stats,
            "coefficients": M.matrix_to_frame(spark, w), "thresholds": thresholds}, {"as_of": str(as_of)})
        seqs.unpersist()
        stats.unpersist()
        return v
    finally:
        vocab.unpersist()
        cells.unpersist()


def detect_sequence(logs: DataFrame, root: str, as_of, minutes: int = SEQUENCE_MINUTES) -> DataFrame:
    """One record per trained series with enough minutes for a sequence."""
    _need(logs, SEQUENCE)
    _, t = M.load_tables(logs.sparkSession, root, SEQUENCE, ["vocab", "scaler", "coefficients", "thresholds"])
    rows = collected(logs, as_of, minutes)
    seqs = SQ.sequences(SQ.scaled_minute_vectors(_minute_cells(rows), t["vocab"], t["scaler"]))
    errors = FC.forecast_errors(seqs, M.matrix_from_frame(t["coefficients"]))
    counts = rows.groupBy(F.col("source_file").alias("series_key")).agg(F.count(F.lit(1)).alias("log_count"))
    found = SQ.error_summary(errors, threshold=t["thresholds"]).join(counts, "series_key")
    return conform(found.select(
        _record_id(SEQUENCE, F.col("series_key"), F.lit(str(as_of))).alias("anomaly_id"), _at(as_of).alias("timestamp"),
        F.lit(SEQUENCE).alias("detector_type"), "is_anomaly", "max_error", "mean_error", "threshold", "anomaly_count",
        "total_sequences", "log_count", F.lit(minutes).alias("time_window_minutes")))


# ---------------------------------------------------------------- messages

def _messages(rows: DataFrame) -> DataFrame:
    """Distinct non-empty messages and how many rows hold each."""
    return rows.where(F.length("message") > 0).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


def _located(encoder, clusters, messages: DataFrame) -> DataFrame:
    vecs = EM.encoded(encoder, messages).select("message", "n", "features")     # sparse
    return CL.kmeans_assign(clusters, vecs).select("message", "n", "cluster", "distance")


def train_message(logs: DataFrame, root: str, as_of, minutes: int = TRAIN_MINUTES, k: int = KMEANS_K, choose_k: bool = False) -> int | None:
    """Encoder, centroids and per-cluster distance profile of the distinct messages.
    With ``choose_k`` the silhouette search sets ``k`` and the model is fitted anew."""
    if missing_columns(logs, MESSAGE):
        return None
    spark = logs.sparkSession
    messages = _messages(collected(logs, as_of, minutes)).persist()
    try:
        if messages.isEmpty():
            return None
        encoder, vecs = EM.tfidf_vectors(messages, "message")
        if choose_k:
            k = CL.best_k(CL.k_search(vecs.select(SP.entries(F.col("features")).alias("vec")), "vec", k), k)
        clusters = CL.kmeans_fit(vecs, k=k)
        profile = CL.distance_profile(_located(encoder, clusters, messages))
        v = _next_version(logs, root, MESSAGE)
        d = M.version_dir(root, MESSAGE, v)
        encoder.write().overwrite().save(f"{d}/encoder")
        clusters.write().overwrite().save(f"{d}/clusters")
        M.save_tables(spark, root, MESSAGE, v, {"cluster_profile": profile}, {"k": k, "as_of": str(as_of)})
        return v
    finally:
        messages.unpersist()


def flagged_messages(logs: DataFrame, root: str, as_of, minutes: int = MESSAGE_MINUTES) -> DataFrame:
    """(message, n, cluster, distance, is_anomaly) of the window's distinct messages."""
    _need(logs, MESSAGE)
    spark = logs.sparkSession
    v = M.latest_version(spark, root, MESSAGE)
    _, t = M.load_tables(spark, root, MESSAGE, ["cluster_profile"], v)
    d = M.version_dir(root, MESSAGE, v)
    located = _located(PipelineModel.load(f"{d}/encoder"), KMeansModel.load(f"{d}/clusters"), _messages(collected(logs, as_of, minutes)))
    return CL.flag_anomalies(located, t["cluster_profile"])


def detect_message(logs: DataFrame, root: str, as_of, minutes: int = MESSAGE_MINUTES) -> DataFrame:
    """One record for the window; counts are of log rows, each message encoded once."""
    one = F.sum(F.when(F.col("is_anomaly"), F.col("n")).otherwise(0))
    per = flagged_messages(logs, root, as_of, minutes).groupBy("cluster").agg(
        F.sum("n").alias("count"), one.alias("anomaly_count"), F.max("distance").alias("top"), F.sum(F.col("distance") * F.col("n")).alias("total"))
    per = per.withColumn("anomaly_ratio", F.col("anomaly_count") / F.col("count"))
    record = per.agg(F.max("top").alias("max_distance"), (F.sum("total") / F.sum("count")).alias("mean_distance"),
                     F.sum("anomaly_count").alias("anomaly_count"), F.sum("count").alias("total_logs"),
                     CL.cluster_stats_map().alias("cluster_stats")).where("total_logs > 0")
    return conform(record.select(
        _record_id(MESSAGE, F.lit(str(as_of))).alias("anomaly_id"), _at(as_of).alias("timestamp"), F.lit(MESSAGE).alias("detector_type"),
        (F.col("anomaly_count") > 0).alias("is_anomaly"), "max_distance", "mean_distance", "anomaly_count", "total_logs",
        F.lit(minutes).alias("time_window_minutes"), "cluster_stats"))


def message_samples(flagged: DataFrame, n: int = 5, chars: int = 100) -> DataFrame:
    """The report's sample: the ``n`` farthest anomalous messages, cut to ``chars`` characters."""
    return (flagged.where("is_anomaly").orderBy(F.col("distance").desc(), "message").limit(n)
            .select(F.substring("message", 1, chars).alias("message"), "cluster", "distance"))


# ---------------------------------------------------------------- all detectors

TRAIN = {FOREST: train_forest, SEQUENCE: train_sequence, MESSAGE: train_message}
DETECT = {FOREST: detect_forest, SEQUENCE: detect_sequence, MESSAGE: detect_message}


def train_all(logs: DataFrame, root: str, as_of, minutes: int = TRAIN_MINUTES) -> dict[str, int | None]:
    return {name: train(logs, root, as_of, minutes) for name, train in TRAIN.items()}


def is_due(logs: DataFrame, root: str, detector: str, as_of, hours: float = RETRAIN_HOURS) -> bool:
    """No model yet, or the latest was fitted ``hours`` before ``as_of`` or longer ago."""
    if M.latest_version(logs.sparkSession, root, detector) is None:
        return True
    meta, _ = M.load_tables(logs.sparkSession, root, detector, [])
    age = datetime.fromisoformat(str(as_of)) - datetime.fromisoformat(meta["as_of"])
    return age >= timedelta(hours=hours)


def train_due(logs: DataFrame, root: str, as_of, minutes: int = TRAIN_MINUTES, hours: float = RETRAIN_HOURS) -> dict[str, int | None]:
    """Train the detectors whose model is missing or too old; the version that
    detection will then use of each (``None``: none, for lack of rows or columns)."""
    for name, train in TRAIN.items():
        if is_due(logs, root, name, as_of, hours):
            train(logs, root, as_of, minutes)
    return {name: M.latest_version(logs.sparkSession, root, name) for name in TRAIN}


def detect_all(logs: DataFrame, root: str, as_of, minutes: dict[str, int] | None = None) -> DataFrame:
    """Records, in the anomaly schema, of every detector that has a stored model and its columns."""
    minutes = {FOREST: FOREST_MINUTES, SEQUENCE: SEQUENCE_MINUTES, MESSAGE: MESSAGE_MINUTES} | (minutes or {})
    found = [detect(logs, root, as_of, minutes[name]) for name, detect in DETECT.items()
             if not missing_columns(logs, name) and M.latest_version(logs.sparkSession, root, name) is not None]
    if not found:
        raise FileNotFoundError(f"no model under {root}")
    return union_detector_outputs(*found)


def cycle(logs: DataFrame, root: str, as_of, minutes: dict[str, int] | None = None) -> DataFrame:
    """One turn of the detectors: train what is missing or a day old, then detect."""
    train_due(logs, root, as_of)
    return detect_all(logs, root, as_of, minutes)
