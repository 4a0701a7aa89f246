"""Registered queries: one Spark job per operator of the survey, each with an
equivalent DuckDB statement (``SQL``) where one exists.

Every query reads the given tables (or views Spark derives from them) in
full; time-range parameters are the operators' own predicates.
"""
from __future__ import annotations

import uuid
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions import constants as CN
from .functions.parse import ts_text
from .functions.severity import severity
from .operators.stats import zscore, zscore_fit
from .plans.detect import BERT_FIELDS, FOREST_FIELDS, LSTM_FIELDS, union_detector_outputs
from .sources import tables as TB

QUERIES: dict = {}
SQL: dict = {}

# Fixed query parameters (the data covers 2024-01-01 .. 2024-01-30).
RANGE_AS_OF = "2024-01-15 12:00:00"
RANGE_MINUTES = 1440
RECENT_AS_OF = "2024-01-20 00:00:00"
RECENT_MINUTES = 1440


_KEPT: list[DataFrame] = []   # frames that the last query persisted


def _kept(df: DataFrame) -> DataFrame:
    """Persist a frame that one query uses several times (memory, then disk;
    recomputed from lineage if an executor is lost)."""
    _KEPT.append(df.persist())
    return df


def query(name, sql=None):
    def deco(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            # a result that is still in use afterwards only loses its cache
            while _KEPT:
                old = _KEPT.pop()
                if old.sparkSession.sparkContext._jsc is not None:   # its session still runs
                    old.unpersist()
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- flagship
# logs → hourly ERROR counts → z-score across hours → grade → ordered report.

@query("error_hour_zscore", O.with_ctes(O.LOGS, """
hourly AS (
  SELECT date_trunc('hour', event_ts) AS hour, count(*) AS n_logs,
         CAST(sum(CASE WHEN log_level = 'ERROR' THEN 1 ELSE 0 END) AS BIGINT) AS n_error
  FROM logs GROUP BY 1),
st AS (SELECT avg(n_error) AS m, stddev_pop(n_error) AS s FROM hourly),
z AS (SELECT hour, n_logs, n_error,
        (n_error - m) / CASE WHEN s = 0 OR s IS NULL THEN 1.0 ELSE s END AS z FROM hourly, st)""") + """
SELECT hour, n_logs, n_error, round(z, 6) AS z_error,
  CASE WHEN z > 3 THEN 'critical' WHEN z > 2 THEN 'high' WHEN z > 1 THEN 'medium' ELSE 'low' END AS grade
FROM z ORDER BY hour""")
def error_hour_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = TB.logs(spark, sf_dir)
    hourly = (logs.groupBy(F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("hour"))
                  .agg(F.count(F.lit(1)).alias("n_logs"),
                       F.sum(F.when(F.col("log_level") == "ERROR", 1).otherwise(0)).cast("bigint").alias("n_error"))
                  .transform(_kept))   # one row per hour; reused by the fit and the report
    m, s = zscore_fit(hourly, "n_error")
    z = zscore(F.col("n_error"), m, s)
    return (hourly.select("hour", "n_logs", "n_error", z.alias("z"))
                  .select("hour", "n_logs", "n_error", r6(F.col("z")).alias("z_error"),
                          F.when(F.col("z") > 3, "critical").when(F.col("z") > 2, "high")
                           .when(F.col("z") > 1, "medium").otherwise("low").alias("grade"))
                  .orderBy("hour"))


# ---------------------------------------------------------------- ingest / parse

@query("parse_logs", O.with_ctes(O.PARSED) + """
SELECT event_id, timestamp, log_level, component, message, raw_log, source_file, collected_at, parse_error
FROM parsed_logs""")
def parse_logs(spark, sf_dir):
    return TB.all_parsed_logs(spark, sf_dir).select(
        "event_id", "timestamp", "log_level", "component", "message", "raw_log", "source_file",
        "collected_at", "parse_error")


@query("quarantine_logs", O.with_ctes(O.PARSED) + """
SELECT event_id, raw_log, source_file,
  CASE WHEN parse_error IS NOT NULL THEN 'parse_error' ELSE 'bad_timestamp' END AS reason
FROM parsed_logs WHERE event_ts IS NULL""")
def quarantine_logs(spark, sf_dir):
    from .sources.ingest import split_quarantine
    _, bad = split_quarantine(TB.all_parsed_logs(spark, sf_dir))
    return bad.select("event_id", "raw_log", "source_file", "reason")


@query("range_scan", O.with_ctes(O.LOGS) + f"""
SELECT event_id, event_ts, log_level, component, message FROM logs
WHERE event_ts BETWEEN TIMESTAMP '{RANGE_AS_OF}' - INTERVAL {RANGE_MINUTES} MINUTE AND TIMESTAMP '{RANGE_AS_OF}'""")
def range_scan(spark, sf_dir):
    return (TB.logs_in_range(spark, sf_dir, RANGE_AS_OF, RANGE_MINUTES)
              .select("event_id", "event_ts", "log_level", "component", "message"))


# ---------------------------------------------------------------- anomaly table

@query("anomaly_union", O.with_ctes(O.ANOMALIES) + """
SELECT anomaly_id, timestamp, detector_type, is_anomaly, time_window_minutes,
  round(anomaly_score, 6) AS anomaly_score, log_count, round(max_error, 6) AS max_error,
  round(mean_error, 6) AS mean_error, threshold, anomaly_count, total_sequences,
  round(max_distance, 6) AS max_distance, round(mean_distance, 6) AS mean_distance, total_logs
FROM anomalies""")
def anomaly_union(spark, sf_dir):
    a = TB.anomalies(spark, sf_dir)
    det = F.col("detector_type")
    forest = a.where(det == "isolation_forest").select(*FOREST_FIELDS)
    lstm = a.where(det == "lstm").select(*LSTM_FIELDS)
    bert = a.where(det == "bert").select(*[c for c in BERT_FIELDS if c != "cluster_stats"])
    other = a.where(~det.isin("isolation_forest", "lstm", "bert")).select(
        "anomaly_id", "timestamp", "detector_type", "is_anomaly", "time_window_minutes")
    u = union_detector_outputs(forest, lstm, bert, other)
    return u.select("anomaly_id", "timestamp", "detector_type", "is_anomaly", "time_window_minutes",
                    r6(F.col("anomaly_score")).alias("anomaly_score"), "log_count",
                    r6(F.col("max_error")).alias("max_error"), r6(F.col("mean_error")).alias("mean_error"),
                    "threshold", "anomaly_count", "total_sequences",
                    r6(F.col("max_distance")).alias("max_distance"),
                    r6(F.col("mean_distance")).alias("mean_distance"), "total_logs")


@query("recent_anomalies", O.with_ctes(O.ANOMALIES) + f"""
SELECT anomaly_id, timestamp, detector_type FROM anomalies
WHERE timestamp BETWEEN TIMESTAMP '{RECENT_AS_OF}' - INTERVAL {RECENT_MINUTES} MINUTE AND TIMESTAMP '{RECENT_AS_OF}'
  AND is_anomaly
ORDER BY timestamp DESC, anomaly_id ASC LIMIT 100""")
def recent_anomalies(spark, sf_dir):
    return (TB.recent_anomalies(TB.anomalies_in_range(spark, sf_dir, RECENT_AS_OF, RECENT_MINUTES),
                                RECENT_AS_OF, RECENT_MINUTES, 100)
              .select("anomaly_id", "timestamp", "detector_type"))


@query("severity", O.with_ctes(O.ANOMALIES) + f"""
SELECT anomaly_id, detector_type, {O.SEVERITY_CASE} AS severity FROM anomalies""")
def severity_q(spark, sf_dir):
    return TB.anomalies(spark, sf_dir).select("anomaly_id", "detector_type", severity().alias("severity"))


# ---------------------------------------------------------------- features
from .operators import features as FT  # noqa: E402
from .operators.dedup import distinct_values, keep_first  # noqa: E402

FEATURE_WIDTH = "1 hour"   # the data is sparse (one log every few minutes), so hour windows
TRAIN_END = "2024-01-15 00:00:00"

_KW_DUCK = ", ".join(f"CASE WHEN contains(lower(message), '{k}') THEN 'keyword_{k}' END"
                     for k in ["error", "exception", "fail", "failed", "timeout", "denied"])
WINDOW_CELLS = f"""
window_cells AS (
  SELECT window_start, feature, count(*) AS n FROM (
    SELECT date_trunc('hour', event_ts) AS window_start,
      unnest(list_filter(['log_level_' || log_level, 'component_' || component,
                          'hour_' || CAST(hour(event_ts) AS VARCHAR), {_KW_DUCK}], lambda x: x IS NOT NULL)) AS feature
    FROM logs) GROUP BY ALL)"""
MINUTE_CELLS = f"""
minute_cells AS (
  SELECT series_key, minute, feature, count(*) AS n FROM (
    SELECT source_file AS series_key, date_trunc('minute', event_ts) AS minute,
      unnest(list_filter([log_level, {_KW_DUCK}, 'component_' || component], lambda x: x IS NOT NULL)) AS feature
    FROM logs) GROUP BY ALL)"""


def _window_cells(spark, sf_dir):
    return FT.window_features(TB.logs(spark, sf_dir), FEATURE_WIDTH).withColumnRenamed("bucket", "window_start")


def _minute_cells(spark, sf_dir):
    logs = TB.logs(spark, sf_dir).withColumnRenamed("source_file", "series_key")
    return FT.minute_features(logs, keys=["series_key"]).withColumnRenamed("bucket", "minute")


@query("window_features", O.with_ctes(O.LOGS, WINDOW_CELLS) + """
SELECT window_start, feature, n FROM window_cells""")
def window_features_q(spark, sf_dir):
    return _window_cells(spark, sf_dir).select("window_start", "feature", "n")


@query("minute_pivot", O.with_ctes(O.LOGS, MINUTE_CELLS) + """
SELECT series_key, minute, feature, n FROM minute_cells""")
def minute_pivot_q(spark, sf_dir):
    return _minute_cells(spark, sf_dir).select("series_key", "minute", "feature", "n")


@query("distinct_components", O.with_ctes(O.LOGS) + """
SELECT DISTINCT component FROM logs""")
def distinct_components(spark, sf_dir):
    return distinct_values(TB.logs(spark, sf_dir), "component")


@query("dedup_message", O.with_ctes(O.LOGS) + """
SELECT message, event_id, dup_count FROM (
  SELECT message, event_id,
    row_number() OVER (PARTITION BY message ORDER BY collected_at, raw_log, event_id) AS rn,
    count(*) OVER (PARTITION BY message) AS dup_count
  FROM logs) WHERE rn = 1""")
def dedup_message(spark, sf_dir):
    logs = TB.logs(spark, sf_dir).select("message", "collected_at", "raw_log", "event_id")
    return keep_first(logs, ["message"], ["collected_at", "raw_log", "event_id"]).select(
        "message", "event_id", "dup_count")


@query("dedup_message_ts", O.with_ctes(O.LOGS) + """
SELECT message, timestamp, event_id, dup_count FROM (
  SELECT message, timestamp, event_id,
    row_number() OVER (PARTITION BY message, timestamp ORDER BY collected_at, raw_log, event_id) AS rn,
    count(*) OVER (PARTITION BY message, timestamp) AS dup_count
  FROM logs) WHERE rn = 1""")
def dedup_message_ts(spark, sf_dir):
    logs = TB.logs(spark, sf_dir).select("message", "timestamp", "collected_at", "raw_log", "event_id")
    return keep_first(logs, ["message", "timestamp"], ["collected_at", "raw_log", "event_id"]).select(
        "message", "timestamp", "event_id", "dup_count")


@query("standard_scale", O.with_ctes(O.LOGS, WINDOW_CELLS, """
nw AS (SELECT count(DISTINCT window_start) AS rows FROM window_cells),
st AS (SELECT feature, sum(n::DOUBLE) / rows AS mean,
         greatest(sum(n::DOUBLE * n::DOUBLE) / rows - (sum(n::DOUBLE) / rows) * (sum(n::DOUBLE) / rows), 0.0) AS var
       FROM window_cells, nw GROUP BY feature, rows)""") + """
SELECT c.window_start, c.feature, round((c.n - st.mean) / CASE WHEN st.var = 0 THEN 1.0 ELSE sqrt(st.var) END, 6) AS z
FROM window_cells c JOIN st USING (feature)""")
def standard_scale(spark, sf_dir):
    cells = _window_cells(spark, sf_dir)
    st = FT.standard_stats(cells, ["window_start"])
    return (FT.apply_scaler(cells, st, "mean", "scale", out="z")
              .select("window_start", "feature", r6(F.col("z")).alias("z")))


@query("minmax_scale", O.with_ctes(O.LOGS, MINUTE_CELLS, """
nm AS (SELECT series_key, count(DISTINCT minute) AS rows FROM minute_cells GROUP BY 1),
st AS (SELECT series_key, feature,
         CASE WHEN count(*) < max(rows) THEN least(min(n), 0)::DOUBLE ELSE min(n)::DOUBLE END AS lo,
         max(n)::DOUBLE AS hi
       FROM minute_cells JOIN nm USING (series_key) GROUP BY 1, 2)""") + """
SELECT c.series_key, c.minute, c.feature,
  round((c.n - st.lo) / CASE WHEN st.hi - st.lo = 0 THEN 1.0 ELSE st.hi - st.lo END, 6) AS scaled
FROM minute_cells c JOIN st USING (series_key, feature)""")
def minmax_scale(spark, sf_dir):
    cells = _minute_cells(spark, sf_dir)
    st = FT.minmax_stats(cells, ["minute"], group_keys=["series_key"])
    return (FT.apply_scaler(cells, st, "min", "range", group_keys=["series_key"])
              .select("series_key", "minute", "feature", r6(F.col("scaled")).alias("scaled")))


@query("align_features", O.with_ctes(O.LOGS, WINDOW_CELLS) + f"""
SELECT window_start, feature, n FROM window_cells
WHERE window_start >= TIMESTAMP '{TRAIN_END}'
  AND feature IN (SELECT feature FROM window_cells WHERE window_start < TIMESTAMP '{TRAIN_END}')""")
def align_features(spark, sf_dir):
    cells = _window_cells(spark, sf_dir)
    cut = F.lit(TRAIN_END).cast("timestamp_ntz")
    vocab = cells.where(F.col("window_start") < cut)
    return FT.align_cells(cells.where(F.col("window_start") >= cut), vocab).select("window_start", "feature", "n")


# ---------------------------------------------------------------- sequences
from .operators import sequences as SQ  # noqa: E402


def _minute_vectors(spark, sf_dir):
    cells = _minute_cells(spark, sf_dir).transform(_kept)   # reused by vocabulary, scaler fit and vectors
    vocab = FT.vocabulary(cells).transform(_kept)
    return SQ.scaled_minute_vectors(cells, vocab)


def _naive_errors(spark, sf_dir):
    steps = SQ.last_steps(_minute_vectors(spark, sf_dir))      # the prediction for a row is the row before it
    return steps.select("series_key", "minute", "seq_idx", "n_seq", SQ.chrono_split(steps).alias("split"),
                        F.round(SQ.mean_abs_error(F.col("prev"), F.col("y")), 10).alias("error"),
                        SQ.squared_error_mean(F.col("prev"), F.col("y")).alias("sq_error"))


DENSE_SCALED = O.with_ctes(O.LOGS, MINUTE_CELLS, """
nm AS (SELECT series_key, count(DISTINCT minute) AS rows FROM minute_cells GROUP BY 1),
st AS (SELECT series_key, feature,
         CASE WHEN count(*) < max(rows) THEN least(min(n), 0)::DOUBLE ELSE min(n)::DOUBLE END AS lo,
         max(n)::DOUBLE AS hi
       FROM minute_cells JOIN nm USING (series_key) GROUP BY 1, 2),
vocab AS (SELECT DISTINCT feature FROM minute_cells),
mins AS (SELECT DISTINCT series_key, minute FROM minute_cells),
dense AS (
  SELECT m.series_key, m.minute, v.feature,
    coalesce((c.n - st.lo) / CASE WHEN st.hi - st.lo = 0 THEN 1.0 ELSE st.hi - st.lo END, 0.0) AS val
  FROM mins m CROSS JOIN vocab v
  LEFT JOIN minute_cells c ON c.series_key = m.series_key AND c.minute = m.minute AND c.feature = v.feature
  LEFT JOIN st ON st.series_key = m.series_key AND st.feature = v.feature),
ranked AS (
  SELECT series_key, minute, feature, val,
    lag(val) OVER (PARTITION BY series_key, feature ORDER BY minute) AS prev,
    dense_rank() OVER (PARTITION BY series_key ORDER BY minute) AS rn,
    count(DISTINCT minute) OVER (PARTITION BY series_key) AS n_rows
  FROM dense),
errs AS (
  SELECT series_key, minute, rn - 11 AS seq_idx, n_rows - 10 AS n_seq,
    round(avg(abs(prev - val)), 10) AS error, avg((prev - val) * (prev - val)) AS sq_error
  FROM ranked WHERE rn > 10 GROUP BY series_key, minute, rn, n_rows)""")


@query("sequences", DENSE_SCALED + """,
tot AS (SELECT series_key, minute, rn, sum(val) AS t FROM ranked GROUP BY 1, 2, 3),
win AS (SELECT series_key, minute, rn, t,
          sum(t) OVER (PARTITION BY series_key ORDER BY rn ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS xs
        FROM tot)
SELECT series_key, minute, 10 AS n_steps, round(xs, 6) AS x_total, round(t, 6) AS y_total
FROM win WHERE rn > 10""")
def sequences_q(spark, sf_dir):
    seqs = SQ.sequences(_minute_vectors(spark, sf_dir))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    return seqs.select("series_key", "minute", F.size("x").alias("n_steps"),
                       r6(F.aggregate(F.col("x"), F.lit(0.0), lambda s, row: s + total(row))).alias("x_total"),
                       r6(total(F.col("y"))).alias("y_total"))


@query("chrono_split", DENSE_SCALED + """
SELECT series_key, minute, CASE WHEN seq_idx < floor(n_seq * 0.8) THEN 'train' ELSE 'validation' END AS split
FROM errs""")
def chrono_split_q(spark, sf_dir):
    return _naive_errors(spark, sf_dir).select("series_key", "minute", "split")


@query("naive_forecast_errors", DENSE_SCALED + """
SELECT series_key, minute, round(error, 6) AS error FROM errs""")
def naive_forecast_errors(spark, sf_dir):
    return _naive_errors(spark, sf_dir).select("series_key", "minute", r6(F.col("error")).alias("error"))


@query("error_threshold", DENSE_SCALED + """,
th AS (SELECT series_key, quantile_cont(error, 0.95) AS threshold FROM errs GROUP BY 1)
SELECT series_key, round(max(error), 6) AS max_error, round(avg(error), 6) AS mean_error,
  round(any_value(threshold), 6) AS threshold,
  CAST(sum(CASE WHEN error > threshold THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
  count(*) AS total_sequences, bool_or(error > threshold) AS is_anomaly
FROM errs JOIN th USING (series_key) GROUP BY series_key""")
def error_threshold(spark, sf_dir):
    s = SQ.error_summary(_naive_errors(spark, sf_dir))
    return s.select("series_key", r6(F.col("max_error")).alias("max_error"),
                    r6(F.col("mean_error")).alias("mean_error"), r6(F.col("threshold")).alias("threshold"),
                    "anomaly_count", "total_sequences", "is_anomaly")


@query("forecast_mse", DENSE_SCALED + """
SELECT series_key, CASE WHEN seq_idx < floor(n_seq * 0.8) THEN 'train' ELSE 'validation' END AS split,
  round(avg(sq_error), 6) AS mse, count(*) AS n
FROM errs GROUP BY 1, 2""")
def forecast_mse(spark, sf_dir):
    e = _naive_errors(spark, sf_dir)
    return (e.groupBy("series_key", "split")
             .agg(r6(F.avg("sq_error")).alias("mse"), F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- message vectors
from .operators import kmeans as KM  # noqa: E402
from .operators import clustering as CL  # noqa: E402

EMB_SCORED = """WITH
e AS (SELECT vec_id, label, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
st AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS s FROM e GROUP BY dim),
z AS (SELECT vec_id, label, dim, (x - m) / CASE WHEN s = 0 OR s IS NULL THEN 1.0 ELSE s END AS z FROM e JOIN st USING (dim)),
cent AS (SELECT label AS cluster, dim, avg(z) AS c FROM z GROUP BY label, dim),
d AS (SELECT z.vec_id, cent.cluster, sum((z.z - cent.c) * (z.z - cent.c)) AS d2
      FROM z JOIN cent USING (dim) GROUP BY z.vec_id, cent.cluster),
asg AS (SELECT vec_id, cluster, round(sqrt(d2), 10) AS distance FROM (
          SELECT vec_id, cluster, d2, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS rn FROM d)
        WHERE rn = 1),
prof AS (SELECT cluster, avg(distance) AS mean_distance, stddev_pop(distance) AS std_distance,
           max(distance) AS max_distance, quantile_cont(distance, 0.95) AS threshold, count(*) AS sample_count
         FROM asg GROUP BY cluster),
flag AS (SELECT a.vec_id, a.cluster, a.distance, coalesce(a.distance > p.threshold, false) AS is_anomaly
         FROM asg a LEFT JOIN prof p USING (cluster))
"""


def _standard_embeddings(emb, *cols):
    return CL.standardized(emb, "embedding", CL.fit_standardizer(emb, "embedding"), "z").select(*cols, "z")


def _scored_embeddings(spark, sf_dir):
    emb = TB.read_table(spark, sf_dir, "embeddings")
    z = _standard_embeddings(emb, "vec_id", "label").transform(_kept)
    cents = CL.fit_group_centroids(z, "z", "label")
    return CL.assign_nearest(z, "z", cents).select("vec_id", "cluster", F.round("distance", 10).alias("distance"))


def _flagged_embeddings(spark, sf_dir):
    scored = _scored_embeddings(spark, sf_dir).transform(_kept)
    return CL.flag_anomalies(scored, CL.distance_profile(scored))


@query("cluster_profile", EMB_SCORED + """
SELECT cluster, round(mean_distance, 6) AS mean_distance, round(std_distance, 6) AS std_distance,
  round(max_distance, 6) AS max_distance, round(threshold, 6) AS threshold, sample_count FROM prof""")
def cluster_profile(spark, sf_dir):
    p = CL.distance_profile(_scored_embeddings(spark, sf_dir))
    return p.select("cluster", *[r6(F.col(c)).alias(c) for c in
                                 ["mean_distance", "std_distance", "max_distance", "threshold"]], "sample_count")


@query("message_anomalies", EMB_SCORED + """
SELECT vec_id, cluster, round(distance, 6) AS distance, is_anomaly FROM flag""")
def message_anomalies(spark, sf_dir):
    f = _flagged_embeddings(spark, sf_dir)
    return f.select("vec_id", "cluster", r6(F.col("distance")).alias("distance"), "is_anomaly")


@query("cluster_stats", EMB_SCORED + """
SELECT cluster, count(*) AS count, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
  round(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) / count(*), 6) AS anomaly_ratio
FROM flag GROUP BY cluster""")
def cluster_stats_q(spark, sf_dir):
    s = CL.cluster_stats(_flagged_embeddings(spark, sf_dir))
    return s.select("cluster", "count", "anomaly_count", r6(F.col("anomaly_ratio")).alias("anomaly_ratio"))


@query("message_summary", EMB_SCORED + """
SELECT round(max(distance), 6) AS max_distance, round(avg(distance), 6) AS mean_distance,
  CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count, count(*) AS total_logs,
  bool_or(is_anomaly) AS is_anomaly
FROM flag""")
def message_summary_q(spark, sf_dir):
    s = CL.message_summary(_flagged_embeddings(spark, sf_dir))
    return s.select(r6(F.col("max_distance")).alias("max_distance"), r6(F.col("mean_distance")).alias("mean_distance"),
                    "anomaly_count", "total_logs", "is_anomaly")


@query("kmeans_messages")
def kmeans_messages(spark, sf_dir):
    """k-means (k=10, seed 42, best of ten starts) on standardised vectors; distance to own centre > cluster p95."""
    emb = TB.read_table(spark, sf_dir, "embeddings")
    z = _standard_embeddings(emb, "vec_id").transform(_kept)
    scored = CL.assign_nearest(z, "z", KM.fit(z, "z").frame(spark)).select("vec_id", "cluster", "distance")
    f = CL.flag_anomalies(scored, CL.distance_profile(scored))
    return f.select("vec_id", "cluster", r6(F.col("distance")).alias("distance"), "is_anomaly")


@query("k_search")
def k_search_q(spark, sf_dir):
    """Silhouette per candidate k (3 .. min(20, n//5) - 1) and the chosen k."""
    emb = TB.read_table(spark, sf_dir, "embeddings")
    scores = CL.k_search(_standard_embeddings(emb), "z")
    chosen = CL.best_k(scores)
    rows = [(k, s, k == chosen) for k, s in scores]
    return spark.createDataFrame(rows, "k int, silhouette double, chosen boolean")


# ---------------------------------------------------------------- alerts
from .plans import alerts as AL  # noqa: E402

# The test anomalies are minutes apart, so the cooldown gaps are scaled x60.
ALERT_GAP = 18000
ALERT_CRITICAL_GAP = 3600

COOLDOWN_SQL = O.with_ctes(O.ANOMALIES) + f""",
ev AS (
  SELECT anomaly_id, detector_type, severity, date_diff('second', TIMESTAMP '1970-01-01 00:00:00', timestamp) AS t,
    row_number() OVER (PARTITION BY detector_type ORDER BY timestamp, anomaly_id) AS rn
  FROM (SELECT *, {O.SEVERITY_CASE} AS severity FROM anomalies WHERE is_anomaly)),
walk AS (
  SELECT detector_type, rn, anomaly_id, severity <> 'low' AS sent,
         CASE WHEN severity <> 'low' THEN t END AS last_t
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.detector_type, e.rn, e.anomaly_id,
    e.severity <> 'low' AND (w.last_t IS NULL OR e.t - w.last_t >= CASE WHEN e.severity = 'critical' THEN {ALERT_CRITICAL_GAP} ELSE {ALERT_GAP} END),
    CASE WHEN e.severity <> 'low' AND (w.last_t IS NULL OR e.t - w.last_t >= CASE WHEN e.severity = 'critical' THEN {ALERT_CRITICAL_GAP} ELSE {ALERT_GAP} END)
         THEN e.t ELSE w.last_t END
  FROM walk w JOIN ev e ON e.detector_type = w.detector_type AND e.rn = w.rn + 1),
decided AS (SELECT w.anomaly_id, w.detector_type, e.severity, w.sent FROM walk w JOIN ev e USING (detector_type, rn))"""
COOLDOWN_SQL = COOLDOWN_SQL.replace("WITH ", "WITH RECURSIVE ", 1)


def _evaluated(spark, sf_dir):
    return AL.evaluate_alerts(TB.anomalies(spark, sf_dir), gap=ALERT_GAP, critical_gap=ALERT_CRITICAL_GAP)


@query("alert_cooldown", COOLDOWN_SQL + """
SELECT anomaly_id, detector_type, severity, sent FROM decided""")
def alert_cooldown(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("anomaly_id", "detector_type", "severity", "sent")


_DETAILS_SQL = """
  '탐지 시간: ' || strftime(a.timestamp, '%Y-%m-%d %H:%M:%S') || chr(10) || '탐지기 유형: ' || a.detector_type ||
  CASE a.detector_type
    WHEN 'isolation_forest' THEN chr(10) || '이상 점수: ' || printf('%.4f', coalesce(a.anomaly_score, 0.0)) || chr(10) ||
         '로그 수: ' || CAST(coalesce(a.log_count, 0) AS VARCHAR) || chr(10) || '시간 범위: ' || CAST(a.time_window_minutes AS VARCHAR) || '분'
    WHEN 'lstm' THEN chr(10) || '평균 오차: ' || printf('%.4f', coalesce(a.mean_error, 0.0)) || chr(10) ||
         '최대 오차: ' || printf('%.4f', coalesce(a.max_error, 0.0)) || chr(10) ||
         '이상 시퀀스: ' || CAST(coalesce(a.anomaly_count, 0) AS VARCHAR) || '/' || CAST(coalesce(a.total_sequences, 0) AS VARCHAR) || chr(10) ||
         '시간 범위: ' || CAST(a.time_window_minutes AS VARCHAR) || '분'
    WHEN 'bert' THEN chr(10) || '평균 거리: ' || printf('%.4f', coalesce(a.mean_distance, 0.0)) || chr(10) ||
         '최대 거리: ' || printf('%.4f', coalesce(a.max_distance, 0.0)) || chr(10) ||
         '이상 로그: ' || CAST(coalesce(a.anomaly_count, 0) AS VARCHAR) || '/' || CAST(coalesce(a.total_logs, 0) AS VARCHAR) || chr(10) ||
         '시간 범위: ' || CAST(a.time_window_minutes AS VARCHAR) || '분'
    ELSE '' END"""
_NAME_SQL = """CASE upper(a.detector_type) WHEN 'ISOLATION_FOREST' THEN '구조화 데이터 분석' WHEN 'LSTM' THEN '시퀀스 패턴 분석'
  WHEN 'BERT' THEN '로그 메시지 의미 분석' ELSE upper(a.detector_type) END"""


_SLACK_SQL = f"""to_json({{channel: '{CN.SLACK_CHANNEL}', username: '{CN.SLACK_USER}', icon_emoji: '{CN.SLACK_ICON}', attachments: [{{
  fallback: message, pretext: '{CN.SLACK_PRETEXT}', title: message, color: color,
  fields: list_concat([{{title: '{CN.SEVERITY_LABEL}', value: upper(severity), short: true}}, {{title: '{CN.DETECTED_LABEL}', value: sent, short: true}}],
    list_transform(string_split(details_text, chr(10)), lambda x: {{title: split_part(x, ': ', 1), value: substr(x, length(split_part(x, ': ', 1)) + 3), short: true}})),
  footer: '{CN.SLACK_FOOTER}', footer_icon: '{CN.SLACK_FOOTER_ICON}', ts: epoch(timestamp)::BIGINT}}]}})::VARCHAR"""
_ESCAPED_SQL = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


def _filled_sql(template, *values):
    texts = template.split("{}")
    return " || ".join([f"'{texts[0]}'", *[c for v, t in zip(values, texts[1:]) for c in (v, f"'{t}'")]])


_MAIL_ROWS_SQL = f"""array_to_string(list_transform(string_split(details_text, chr(10)), lambda x: {_filled_sql(
    AL.MAIL_ROW, _ESCAPED_SQL.format("split_part(x, ': ', 1)"), _ESCAPED_SQL.format("substr(x, length(split_part(x, ': ', 1)) + 3)"))}), '')"""
_MAIL_SQL = _filled_sql(AL.MAIL_BODY, "severity", "upper(severity)", "sent", _ESCAPED_SQL.format("message"), f"({_filled_sql(AL.MAIL_TABLE, _MAIL_ROWS_SQL)})")


@query("alert_outbox", COOLDOWN_SQL + f""",
chans AS (SELECT 'slack' AS channel UNION ALL SELECT 'email'),
told AS (
  SELECT d.anomaly_id, d.detector_type, d.severity, c.channel, a.timestamp, strftime(a.timestamp, '%Y-%m-%d %H:%M:%S') AS sent,
    {_NAME_SQL} || '에서 비정상 로그 패턴이 감지되었습니다.' AS message,
    CASE WHEN c.channel = 'email' THEN
      CASE d.severity WHEN 'critical' THEN '[긴급]' WHEN 'high' THEN '[중요]' ELSE '[알림]' END
      || ' 보안 경고: ' || {_NAME_SQL} || '에서 비정상 패턴 감지' END AS subject,
    CASE WHEN c.channel = 'slack' THEN CASE d.severity WHEN 'low' THEN '#36a64f' WHEN 'medium' THEN '#ffd700'
      WHEN 'high' THEN '#ff9900' WHEN 'critical' THEN '#ff0000' ELSE '#777777' END END AS color,
    {_DETAILS_SQL} AS details_text
  FROM decided d JOIN anomalies a USING (anomaly_id) JOIN chans c
    ON c.channel = 'slack' OR d.severity IN ('high', 'critical')
  WHERE d.sent)
SELECT anomaly_id, detector_type, severity, channel, message, subject, color, details_text,
  CASE WHEN channel = 'slack' THEN {_SLACK_SQL} ELSE {_MAIL_SQL} END AS payload FROM told""")
def alert_outbox_q(spark, sf_dir):
    out = AL.alert_outbox(_evaluated(spark, sf_dir))
    return out.select("anomaly_id", "detector_type", "severity", "channel", "message", "subject",
                      F.when(F.col("channel") == "slack", AL.slack_color(F.col("severity"))).alias("color"),
                      AL.details_text(F.col("details")).alias("details_text"), "payload")


# ---------------------------------------------------------------- incidents
from .plans import incidents as IN  # noqa: E402
from .session import checkpointed, stored  # noqa: E402
from .plans import playbook as PB  # noqa: E402
from .functions.constants import PLAYBOOK_LOG_LIMIT as C_PLAYBOOK_LIMIT  # noqa: E402
from .functions.constants import RELATED_LOG_LIMIT as C_RELATED_LIMIT  # noqa: E402

_TITLE_SQL = """CASE detector_type WHEN 'isolation_forest' THEN '구조화 데이터 분석' WHEN 'lstm' THEN '시퀀스 패턴 분석'
  WHEN 'bert' THEN '로그 메시지 의미 분석' ELSE detector_type END || '에서 발견된 로그 이상 패턴'"""
_DESC_SQL = """'탐지 시간: ' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || chr(10) || '탐지기 유형: ' || detector_type || chr(10) || chr(10) ||
  CASE detector_type
    WHEN 'isolation_forest' THEN '이상 점수: ' || printf('%.4f', coalesce(anomaly_score, 0.0)) || chr(10) ||
      '분석된 로그 수: ' || CAST(coalesce(log_count, 0) AS VARCHAR) || chr(10) ||
      '시간 범위: ' || CAST(coalesce(time_window_minutes, 0) AS VARCHAR) || '분' || chr(10)
    WHEN 'lstm' THEN '평균 오차: ' || printf('%.4f', coalesce(mean_error, 0.0)) || chr(10) ||
      '최대 오차: ' || printf('%.4f', coalesce(max_error, 0.0)) || chr(10) ||
      '이상 시퀀스: ' || CAST(coalesce(anomaly_count, 0) AS VARCHAR) || '/' || CAST(coalesce(total_sequences, 0) AS VARCHAR) || chr(10) ||
      '시간 범위: ' || CAST(coalesce(time_window_minutes, 0) AS VARCHAR) || '분' || chr(10)
    WHEN 'bert' THEN '평균 거리: ' || printf('%.4f', coalesce(mean_distance, 0.0)) || chr(10) ||
      '최대 거리: ' || printf('%.4f', coalesce(max_distance, 0.0)) || chr(10) ||
      '이상 로그: ' || CAST(coalesce(anomaly_count, 0) AS VARCHAR) || '/' || CAST(coalesce(total_logs, 0) AS VARCHAR) || chr(10) ||
      '시간 범위: ' || CAST(coalesce(time_window_minutes, 0) AS VARCHAR) || '분' || chr(10)
    ELSE '' END"""

INCIDENT_CTES = O.with_ctes(O.LOGS, O.ANOMALIES, f"""
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY timestamp, detector_type, coalesce(anomaly_score, mean_error),
        CASE WHEN anomaly_score IS NOT NULL THEN 's' WHEN mean_error IS NOT NULL THEN 'e' END
        ORDER BY anomaly_id) AS rn
    FROM anomalies WHERE is_anomaly) WHERE rn = 1),
sev AS (SELECT *, {O.SEVERITY_CASE} AS severity FROM deduped),
incidents AS (
  SELECT md5(strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '_' || detector_type || '_' || CAST(anomaly_id AS VARCHAR)) AS incident_id,
    {_TITLE_SQL} AS title, {_DESC_SQL} AS description, *
  FROM sev WHERE severity <> 'low'),
rel AS (
  SELECT * FROM (
    SELECT i.incident_id, l.event_id, l.event_ts, l.timestamp AS log_ts, l.log_level, l.component, l.message,
      row_number() OVER (PARTITION BY i.incident_id ORDER BY l.event_ts, l.event_id) AS rank
    FROM incidents i JOIN logs l
      ON l.event_ts BETWEEN i.timestamp - INTERVAL 30 MINUTE AND i.timestamp + INTERVAL 5 MINUTE)
  WHERE rank <= 1000),
hc AS (SELECT * FROM incidents WHERE severity IN ('high', 'critical')),
ctx AS (SELECT incident_id, count(*) AS n, bool_or(log_level = 'ERROR') AS has_error FROM rel GROUP BY 1)""")


class _Flow:
    """The incident flow over one sf directory.  Each part is made when a query first
    asks for it; parts that several others use are written to the checkpoint folder
    (incidents, with and without context) or persisted (logs; recomputed from lineage if an executor is lost)."""

    def __init__(self, spark, sf_dir, log_cols=None):
        self.spark, self.sf_dir, self.log_cols = spark, sf_dir, log_cols

    @cached_property
    def incidents(self):
        return stored(IN.build_incidents(IN.dedup_anomalies(TB.anomalies(self.spark, self.sf_dir))), "incidents")

    @cached_property
    def related(self):
        """The logs, numbered once for the context, the playbook and the decisions."""
        logs = TB.logs(self.spark, self.sf_dir)
        logs = (logs.select(*self.log_cols) if self.log_cols else logs).transform(_kept)      # stands for a stored log table
        return IN.related_positions(self.incidents, logs, C_RELATED_LIMIT, log_cols=self.log_cols or IN.LOG_COLUMNS, keep=_kept, cut=checkpointed)

    @cached_property
    def enriched(self):
        return stored(IN.enrich(self.incidents, IN.context(self.related, by_second=True)), "enriched")

    @cached_property
    def requests(self):
        return IN.workflow_requests(self.incidents)

    @cached_property
    def serious(self):
        """High and critical incidents, without context."""
        return self.incidents.where(F.col("severity").isin("high", "critical"))

    @cached_property
    def hc(self):
        return self.enriched.where(F.col("severity").isin("high", "critical"))

    @cached_property
    def analysis(self):
        """The playbook's own search: first 100 related logs of serious incidents only."""
        return PB.analyse(self.serious, self.related, C_PLAYBOOK_LIMIT)

    @cached_property
    def decisions(self):
        return PB.decide(self.hc, self.analysis)

    def events(self):
        res = self.requests.join(self.enriched.select("incident_id", "created_at"), "incident_id").select(
            "incident_id", F.col("created_at").alias("event_time"), F.lit(True).alias("accepted"),
            F.col("incident_id").alias("execution_id"), F.lit(None).cast("string").alias("error"))
        closes = PB.closes(self.decisions.join(self.enriched.select("incident_id", "created_at"), "incident_id"),
                           F.col("created_at"))
        return IN.incident_events(self.enriched, res, closes)


@query("incident_dedup", INCIDENT_CTES + """
SELECT anomaly_id, severity FROM sev""")
def incident_dedup(spark, sf_dir):
    return IN.dedup_anomalies(TB.anomalies(spark, sf_dir)).select("anomaly_id", "severity")


@query("incidents", INCIDENT_CTES + """
SELECT incident_id, anomaly_id, severity, 'new' AS status, title, description FROM incidents""")
def incidents_q(spark, sf_dir):
    f = _Flow(spark, sf_dir)
    return f.incidents.select("incident_id", "anomaly_id", "severity", "status", "title", "description")


@query("related_logs", INCIDENT_CTES + """
SELECT incident_id, event_id, rank FROM rel""")
def related_logs_q(spark, sf_dir):
    related = _Flow(spark, sf_dir, ("event_id", "event_ts")).related
    return IN.related_logs(related, C_RELATED_LIMIT).select("incident_id", "event_id", F.col("rank").cast("bigint").alias("rank"))


@query("incident_context", INCIDENT_CTES + """
SELECT incident_id, 'total' AS stat, '' AS key, count(*) AS n FROM rel GROUP BY 1
UNION ALL SELECT incident_id, 'level', coalesce(log_level, 'unknown'), count(*) FROM rel GROUP BY 1, 3
UNION ALL SELECT incident_id, 'component', coalesce(component, 'unknown'), count(*) FROM rel GROUP BY 1, 3
UNION ALL SELECT i.incident_id, 'all', '', count(*) FROM incidents i JOIN logs l
  ON l.event_ts BETWEEN i.timestamp - INTERVAL 30 MINUTE AND i.timestamp + INTERVAL 5 MINUTE GROUP BY 1""")
def incident_context(spark, sf_dir):
    c = _Flow(spark, sf_dir).enriched.where(F.col("context").isNotNull())
    tot = c.select("incident_id", F.lit("total").alias("stat"), F.lit("").alias("key"),
                   F.col("context.related_logs_count").alias("n"))
    lv = c.select("incident_id", F.lit("level").alias("stat"), F.explode("context.log_level_stats").alias("key", "n"))
    co = c.select("incident_id", F.lit("component").alias("stat"), F.explode("context.component_stats").alias("key", "n"))
    every = c.select("incident_id", F.lit("all").alias("stat"), F.lit("").alias("key"), F.col("related_logs_total").alias("n"))
    return tot.unionByName(lv).unionByName(co).unionByName(every)


@query("incident_samples", INCIDENT_CTES + """
SELECT incident_id, rank AS idx, log_ts, message FROM rel WHERE rank <= 10""")
def incident_samples(spark, sf_dir):
    c = _Flow(spark, sf_dir).enriched.where(F.col("context").isNotNull())
    s = c.select("incident_id", F.posexplode("context.log_samples").alias("i", "s"))
    return s.select("incident_id", (F.col("i") + 1).cast("bigint").alias("idx"),
                    F.col("s.timestamp").alias("log_ts"), F.col("s.message").alias("message"))


@query("workflow_requests", INCIDENT_CTES + """
SELECT incident_id, severity, title, description, 'new' AS status, detector_type,
  strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS created,
  strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS updated, CAST(anomaly_id AS VARCHAR) AS anomaly_id,
  CAST(anomaly_count AS VARCHAR) AS anomaly_count, CAST(time_window_minutes AS VARCHAR) AS window_minutes, '[]' AS actions FROM hc""")
def workflow_requests_q(spark, sf_dir):
    r = _Flow(spark, sf_dir).requests
    field = lambda path: F.get_json_object("execution_argument", f"$.{path}")
    return r.select(field("incident_id").alias("incident_id"), field("severity").alias("severity"), field("title").alias("title"),
                    field("description").alias("description"), field("status").alias("status"), field("detector_type").alias("detector_type"),
                    field("timestamp").alias("ts"), field("created_at").alias("created"), field("updated_at").alias("updated"),
                    field("anomaly_data.anomaly_id").alias("anomaly_id"), field("anomaly_data.anomaly_count").alias("anomaly_count"),
                    field("anomaly_data.time_window_minutes").alias("window_minutes"), field("actions").alias("actions"))


@query("incident_lookup", INCIDENT_CTES + """
SELECT incident_id, severity, title FROM incidents WHERE incident_id IN (SELECT incident_id FROM hc)""")
def incident_lookup(spark, sf_dir):
    f = _Flow(spark, sf_dir)
    return f.incidents.join(f.requests.select("incident_id"), "incident_id", "left_semi").select(
        "incident_id", "severity", "title")


_STATE_SQL = INCIDENT_CTES + """,
st AS (SELECT i.incident_id, c.n, coalesce(c.n, 0) > 0 AS has_ctx, i.severity IN ('high', 'critical') AS is_hc
       FROM incidents i LEFT JOIN ctx c USING (incident_id))"""


def _actions_text(col):
    return F.array_join(F.transform(col, lambda a: F.concat(a["action_type"], F.lit(": "), a["description"])), " | ")


@query("incident_state", _STATE_SQL + """
SELECT incident_id, CASE WHEN is_hc THEN 'responded' ELSE 'new' END AS status,
  CAST(has_ctx AS INTEGER) + CASE WHEN is_hc THEN 3 ELSE 0 END AS n_actions,
  concat_ws(' | ', CASE WHEN has_ctx THEN 'context_enrichment: 관련 로그 ' || CAST(n AS VARCHAR) || '개를 추가하여 컨텍스트 정보 보강' END,
    CASE WHEN is_hc THEN 'workflow_execution: 워크플로우 실행 시작 (실행 ID: ' || incident_id || ')' END,
    CASE WHEN is_hc THEN 'status_change: 인시던트 상태가 ''in_progress''(으)로 변경되었습니다. 사유: 자동화된 워크플로우 실행 중' END,
    CASE WHEN is_hc THEN 'automated_response: 자동화된 대응 수행 완료' END) AS actions
FROM st""")
def incident_state_q(spark, sf_dir):
    s = IN.incident_state(_Flow(spark, sf_dir).events())
    return s.select("incident_id", "status", F.size("actions").alias("n_actions"), _actions_text("actions").alias("actions"))


@query("incident_update", _STATE_SQL + """
SELECT incident_id, CASE WHEN is_hc THEN 'responded' ELSE 'new' END AS status,
  CAST(has_ctx AS INTEGER) + CASE WHEN is_hc THEN 1 ELSE 0 END AS n_actions FROM st""")
def incident_update(spark, sf_dir):
    f = _Flow(spark, sf_dir)
    doc = f.decisions.join(f.enriched.select("incident_id", "created_at"), "incident_id").select(
        "incident_id", F.lit("responded").alias("status"),
        F.array(IN.action("automated_response", F.lit("자동화된 대응 수행 완료"), F.col("created_at"))).alias("actions"))
    u = IN.partial_update(f.enriched.select("incident_id", "status", "actions"), doc)
    return u.select("incident_id", "status", F.size("actions").alias("n_actions"))


@query("incident_upsert", _STATE_SQL + """
SELECT incident_id, CASE WHEN is_hc THEN 'responded' ELSE 'new' END AS status FROM st""")
def incident_upsert(spark, sf_dir):
    f = _Flow(spark, sf_dir)
    old = f.enriched.select("incident_id", "status", F.col("created_at").alias("updated_at"))
    new = IN.incident_state(f.events()).join(f.requests.select("incident_id"), "incident_id", "left_semi") \
            .select("incident_id", "status", (F.col("updated_at") + F.expr("INTERVAL 1 SECOND")).alias("updated_at"))
    return IN.upsert(old, new).select("incident_id", "status")


# ---------------------------------------------------------------- playbook
_KW6 = ["error", "exception", "failed", "timeout", "denied", "invalid"]
PLAYBOOK_CTES = INCIDENT_CTES + """,
rel100 AS (SELECT * FROM rel WHERE rank <= 100),
agg AS (SELECT incident_id, count(*) AS log_count,
    CAST(sum(CASE WHEN log_level IN ('ERROR', 'FATAL', 'CRITICAL') AND coalesce(message, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n_err,
    min(event_ts) AS t_min, max(event_ts) AS t_max, """ + ", ".join(
    f"CAST(sum(CASE WHEN contains(lower(coalesce(message, '')), '{k}') THEN 1 ELSE 0 END) AS BIGINT) AS kw_{i}"
    for i, k in enumerate(_KW6)) + """
  FROM rel100 GROUP BY 1),
lvl AS (SELECT incident_id, coalesce(log_level, 'unknown') AS lvl, count(*) AS c FROM rel100 GROUP BY 1, 2),
mode AS (SELECT incident_id, lvl, c FROM (
  SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY c DESC, lvl) AS rn FROM lvl) WHERE rn = 1),
errs AS (SELECT incident_id, list(message ORDER BY rank) AS s FROM (
  SELECT incident_id, message, rank, row_number() OVER (PARTITION BY incident_id ORDER BY rank) AS k FROM rel100
  WHERE log_level IN ('ERROR', 'FATAL', 'CRITICAL') AND coalesce(message, '') <> '') WHERE k <= 3 GROUP BY 1),
analysis AS (
  SELECT h.incident_id, h.detector_type, h.severity, h.title, h.description, h.timestamp, coalesce(a.log_count, 0) AS log_count,
    CASE h.detector_type
      WHEN 'isolation_forest' THEN list_filter([
        CASE WHEN m.lvl IS NOT NULL THEN '가장 많은 로그 레벨: ' || m.lvl || ' (' || CAST(m.c AS VARCHAR) || '개)' END,
        CASE WHEN a.n_err > 0 THEN '에러 메시지 ' || CAST(a.n_err AS VARCHAR) || '개 발견' END], lambda x: x IS NOT NULL)
      WHEN 'lstm' THEN list_filter([
        CASE WHEN coalesce(a.log_count, 0) >= 2 THEN '로그 간 평균 시간 간격: ' ||
          printf('%.1f', round_even(date_diff('second', a.t_min, a.t_max) / CAST(a.log_count - 1 AS DOUBLE), 1)) || '초' END],
        lambda x: x IS NOT NULL)
      WHEN 'bert' THEN list_filter([""" + ", ".join(
    f"CASE WHEN a.kw_{i} > 0 THEN '키워드 \"{k}\": ' || CAST(a.kw_{i} AS VARCHAR) || '개 발견' END"
    for i, k in enumerate(_KW6)) + """], lambda x: x IS NOT NULL)
      ELSE CAST([] AS VARCHAR[]) END AS patterns,
    CASE WHEN h.detector_type = 'isolation_forest' AND a.n_err > 0 THEN e.s END AS error_samples
  FROM hc h LEFT JOIN agg a USING (incident_id) LEFT JOIN mode m USING (incident_id) LEFT JOIN errs e USING (incident_id))"""


@query("playbook_route", INCIDENT_CTES + """
SELECT incident_id, CASE severity WHEN 'critical' THEN 'urgent_notice' WHEN 'high' THEN 'normal_notice'
  ELSE 'collect' END AS route FROM hc""")
def playbook_route(spark, sf_dir):
    return _Flow(spark, sf_dir).serious.select("incident_id", PB.route(F.col("severity")).alias("route"))


@query("playbook_notices", INCIDENT_CTES + """
SELECT incident_id, CASE WHEN severity = 'critical' THEN 'sms' ELSE 'email' END AS channel,
  CASE WHEN severity = 'high' THEN '보안 경고: ' || title END AS subject,
  CASE WHEN severity = 'critical' THEN '긴급 보안 경고: ' || title || ' - ' ||
         CASE WHEN length(description) > 100 THEN substr(description, 1, 97) || '...' ELSE description END
       ELSE description || chr(10) || chr(10) || '심각도: ' || severity || chr(10) || '탐지 시간: ' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') END AS body
FROM hc""")
def playbook_notices(spark, sf_dir):
    return PB.notices(_Flow(spark, sf_dir).serious)


@query("related_analysis", PLAYBOOK_CTES + """
SELECT incident_id, detector_type, log_count, len(patterns) AS n_patterns,
  error_samples IS NOT NULL AS has_error_samples, coalesce(len(error_samples), 0) AS n_error_samples FROM analysis""")
def related_analysis(spark, sf_dir):
    a = _Flow(spark, sf_dir).analysis
    return a.select("incident_id", "detector_type", "log_count", F.size("patterns").cast("bigint").alias("n_patterns"),
                    F.col("error_samples").isNotNull().alias("has_error_samples"),
                    F.coalesce(F.size("error_samples"), F.lit(0)).cast("bigint").alias("n_error_samples"))


@query("analysis_patterns", PLAYBOOK_CTES + """
SELECT incident_id, idx, pattern FROM (
  SELECT incident_id, unnest(range(1, len(patterns) + 1)) AS idx, unnest(patterns) AS pattern FROM analysis)
UNION ALL
SELECT incident_id, 100 + unnest(range(1, len(error_samples) + 1)) AS idx, unnest(error_samples) AS pattern
FROM analysis WHERE error_samples IS NOT NULL""")
def analysis_patterns(spark, sf_dir):
    a = _Flow(spark, sf_dir).analysis
    p = a.select("incident_id", F.posexplode("patterns").alias("i", "pattern"))
    e = a.select("incident_id", F.posexplode("error_samples").alias("i", "pattern"))
    return (p.select("incident_id", (F.col("i") + 1).cast("bigint").alias("idx"), "pattern")
             .unionByName(e.select("incident_id", (F.col("i") + 101).cast("bigint").alias("idx"), "pattern")))


@query("tickets", PLAYBOOK_CTES + """
SELECT incident_id, title AS short_description,
  description || chr(10) || chr(10) || '분석 결과:' || chr(10) ||
    array_to_string(list_transform(patterns, lambda p: '- ' || p || chr(10)), '') ||
    chr(10) || chr(10) || '관련 로그 수: ' || CAST(log_count AS VARCHAR) || '개' AS description,
  CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 ELSE 3 END AS urgency, 'security' AS category
FROM analysis""")
def tickets_q(spark, sf_dir):
    f = _Flow(spark, sf_dir)
    return PB.tickets(f.serious, f.analysis)


@query("response_decision", PLAYBOOK_CTES + """
SELECT a.incident_id,
  CASE WHEN coalesce(c.has_error, false) THEN 'log_level_based_response'
       WHEN a.error_samples IS NOT NULL THEN 'error_message_based_response' ELSE 'default_response' END AS action,
  true AS completed,
  CASE WHEN coalesce(c.has_error, false) THEN '대상 시스템 상태 확인 및 로그 패턴 분석 완료'
       WHEN a.error_samples IS NOT NULL THEN '에러 메시지 분석 및 관련 서비스 상태 점검 완료'
       ELSE '기본 모니터링 및 로그 수집 강화' END AS details
FROM analysis a LEFT JOIN ctx c USING (incident_id)""")
def response_decision(spark, sf_dir):
    return _Flow(spark, sf_dir).decisions


# ---------------------------------------------------------------- detectors
from .operators import clustering as _CL  # noqa: E402,F811
from .operators import cooldown as CD  # noqa: E402
from .operators import forest as FO  # noqa: E402


def _window_vectors(spark, sf_dir):
    """Standardised dense window-feature vectors (hour windows) and log counts."""
    logs = TB.logs(spark, sf_dir)
    cells = FT.window_features(logs, FEATURE_WIDTH).withColumnRenamed("bucket", "window_start").transform(_kept)
    vecs = FT.dense_vectors(cells, FT.vocabulary(cells).transform(_kept), ["window_start"])
    counts = logs.groupBy(FT.time_windows(F.col("event_ts"), FEATURE_WIDTH).alias("window_start")) \
                 .agg(F.count(F.lit(1)).alias("log_count"))
    vecs = vecs.join(counts, "window_start").transform(_kept)
    return _CL.standardized(vecs, "vec", _CL.fit_standardizer(vecs, "vec"), "x").select("window_start", "log_count", "x")


@query("forest_scores")
def forest_scores(spark, sf_dir):
    """Isolation-forest records per hour window: score in [-1, 0], anomaly when
    below the 5 % training quantile (trained on the same windows)."""
    x = _window_vectors(spark, sf_dir).withColumn("key", F.col("window_start").cast("string")).transform(_kept)
    model = FO.fit_forest(x, "key", "x")
    scored = FO.score_forest(x.select("window_start", "log_count", "x"), "x", model).transform(_kept)
    offset = FO.fit_offset(scored)
    return scored.select(
        F.col("window_start").alias("timestamp"), F.lit("isolation_forest").alias("detector_type"),
        r6(F.col("anomaly_score")).alias("anomaly_score"), (F.col("anomaly_score") < F.lit(offset)).alias("is_anomaly"),
        F.col("log_count").cast("bigint").alias("log_count"), F.lit(60).cast("bigint").alias("time_window_minutes"))


from .operators import forecast as FC  # noqa: E402


@query("sequence_forecast")
def sequence_forecast(spark, sf_dir):
    """Ridge VAR fitted on the training 80 % of each series' sequences; per
    series: p95 error threshold, anomaly count (error > threshold), validation MSE."""
    seqs = SQ.sequences(_minute_vectors(spark, sf_dir))
    seqs = seqs.withColumn("split", SQ.chrono_split(seqs)).transform(_kept)
    w = FC.fit_ridge(seqs.where(F.col("split") == "train"))
    errs = FC.forecast_errors(seqs.drop("x_total"), w).transform(_kept)
    summ = SQ.error_summary(errs)
    val = errs.where(F.col("split") == "validation").groupBy("series_key").agg(F.avg("sq_error").alias("val_mse"))
    return (summ.join(val, "series_key", "left")
                .select("series_key", F.lit("lstm").alias("detector_type"),
                        r6(F.col("max_error")).alias("max_error"), r6(F.col("mean_error")).alias("mean_error"),
                        r6(F.col("threshold")).alias("threshold"), "anomaly_count", "total_sequences",
                        "is_anomaly", r6(F.col("val_mse")).alias("val_mse")))


from .operators import embedding as EM  # noqa: E402
from .operators import sparse as SP  # noqa: E402


@query("text_embedding")
def text_embedding(spark, sf_dir):
    """TF-IDF message vectors of the whole documents table, distinct texts
    first (keep-first by doc_id), then distance-to-centroid scoring with
    k-means (k=10) on those vectors."""
    docs = TB.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    uniq = keep_first(docs, ["text"], ["doc_id"], count_col=None)
    _, vec = EM.tfidf_vectors(uniq, "text")
    vec = vec.select("doc_id", "features").transform(_kept)      # sparse
    model = CL.kmeans_fit(vec, k=10)
    scored = CL.kmeans_assign(model, vec).select("doc_id", SP.n_terms(SP.entries(F.col("features"))).alias("n_terms"), "cluster", "distance").transform(_kept)
    f = CL.flag_anomalies(scored, CL.distance_profile(scored))
    return f.select("doc_id", "n_terms", "cluster", r6(F.col("distance")).alias("distance"), "is_anomaly")


def _detector_records(spark, sf_dir):
    """The three detectors' records in one anomaly table: each with a stable id
    (hash of detector and scored unit), the end of the scored time as timestamp
    and its true length."""
    rid = lambda det, unit: F.xxhash64(F.lit(det), unit)
    logs = TB.logs(spark, sf_dir)
    span = logs.agg(F.max("event_ts").alias("as_of"), F.min("event_ts").alias("since")).where("as_of IS NOT NULL").select(
        "as_of", F.timestamp_diff("MINUTE", F.col("since"), F.col("as_of")).alias("minutes"), F.lit(0).alias("_g"))
    at_end = lambda df: df.withColumn("_g", F.lit(0)).join(F.broadcast(span), "_g").drop("_g")  # noqa: E731  (one row)
    forest = forest_scores(spark, sf_dir)
    forest = (forest.withColumn("anomaly_id", rid("isolation_forest", F.col("timestamp").cast("string")))
              .withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 HOUR")))
    per_series = logs.groupBy(F.col("source_file").alias("series_key")).agg(F.count(F.lit(1)).alias("log_count"))
    seq = at_end(sequence_forecast(spark, sf_dir).join(per_series, "series_key")).select(
        rid("lstm", F.concat_ws("_", "series_key", F.col("as_of").cast("string"))).alias("anomaly_id"), F.col("as_of").alias("timestamp"),
        "detector_type", "is_anomaly", "max_error", "mean_error", "threshold", "anomaly_count", "total_sequences", "log_count",
        F.col("minutes").alias("time_window_minutes"))
    flagged = _flagged_embeddings(spark, sf_dir)
    stats = CL.cluster_stats(flagged).agg(CL.cluster_stats_map().alias("cluster_stats"))
    msg = at_end(CL.message_summary(flagged)).select(
        rid("bert", F.col("as_of").cast("string")).alias("anomaly_id"), F.col("as_of").alias("timestamp"), F.lit("bert").alias("detector_type"),
        "is_anomaly", "max_distance", "mean_distance", "anomaly_count", "total_logs", F.col("minutes").alias("time_window_minutes"))
    one = F.lit(0).alias("_g")   # both sides are single-row aggregates
    msg = msg.select("*", one).join(F.broadcast(stats.select("*", one)), "_g").drop("_g")
    return union_detector_outputs(forest, seq, msg)


@query("detector_records")
def detector_records(spark, sf_dir):
    return _detector_records(spark, sf_dir).withColumn("n_clusters", F.size("cluster_stats")).drop("cluster_stats")


@query("detector_alerts")
def detector_alerts(spark, sf_dir):
    """The detectors' own records through severity and cooldown."""
    rec = _detector_records(spark, sf_dir).where("is_anomaly").withColumn("severity", severity())
    rec = rec.select("anomaly_id", "timestamp", "detector_type", "severity").transform(_kept)   # models aren't fitted twice
    return CD.cooldown(rec).select("anomaly_id", "timestamp", "detector_type", "severity", "sent")


@query("collected_range_scan", O.with_ctes(O.LOGS) + f"""
SELECT event_id, log_level, component, collected_at FROM logs
WHERE collected_at BETWEEN TIMESTAMP '{RANGE_AS_OF}' - INTERVAL {RANGE_MINUTES} MINUTE AND TIMESTAMP '{RANGE_AS_OF}'""")
def collected_range_scan(spark, sf_dir):
    """Inclusive range on the collection time, as the detectors' scans have it."""
    return TB.collected_in_range(spark, sf_dir, RANGE_AS_OF, RANGE_MINUTES).select("event_id", "log_level", "component", "collected_at")


@query("anomaly_samples")
def anomaly_samples(spark, sf_dir):
    """Sample of anomalous sequences for the detector log (3, without
    replacement): a seeded hash order instead of a random draw, so reruns agree;
    the sample is the feature, hence the limit."""
    e = _naive_errors(spark, sf_dir)
    th = e.groupBy("series_key").agg(F.percentile(F.col("error"), 0.95).alias("threshold"))
    bad = e.join(th, "series_key").where(F.col("error") > F.col("threshold"))
    return (bad.orderBy(F.xxhash64("series_key", "minute", F.lit(42)), "series_key", "minute").limit(3)
               .select("series_key", "minute", r6(F.col("error")).alias("error"),
                       F.substring(F.concat(F.lit("error "), F.col("error").cast("string")), 1, 100).alias("note")))


from .plans import lifecycle as LC  # noqa: E402
from .schemas import ACTION  # noqa: E402
from .session import scratch_path  # noqa: E402

CYCLE_AS_OF = ("2024-01-20 00:00:00", "2024-02-01 00:00:00")   # end of training, end of detection
CYCLE_MINUTES = (30 * 1440, 13 * 1440)
ACTIONS_TYPE = f"array<{ACTION.simpleString()}>"


@query("detector_cycle")
def detector_cycle(spark, sf_dir):
    """Detectors trained on the logs up to one time, stored, loaded again and
    applied to the logs collected after it."""
    logs = TB.logs(spark, sf_dir)
    root = scratch_path(spark, f"models-{uuid.uuid4().hex}")
    LC.train_all(logs, root, CYCLE_AS_OF[0], CYCLE_MINUTES[0])
    found = LC.detect_all(logs, root, CYCLE_AS_OF[1], dict.fromkeys((LC.FOREST, LC.SEQUENCE, LC.MESSAGE), CYCLE_MINUTES[1]))
    return found.withColumn("n_clusters", F.size("cluster_stats")).drop("cluster_stats")


@query("workflow_outcomes", INCIDENT_CTES + """,
told AS (SELECT *, CASE WHEN anomaly_id % 5 = 0 THEN 'error' WHEN severity = 'high' THEN 'failed' ELSE 'accepted' END AS outcome FROM hc)
SELECT incident_id, CASE WHEN outcome = 'accepted' THEN 'in_progress' ELSE 'new' END AS status,
  CASE outcome WHEN 'accepted' THEN 'workflow_execution: 워크플로우 실행 시작 (실행 ID: ' || incident_id ||
      ') | status_change: 인시던트 상태가 ''in_progress''(으)로 변경되었습니다. 사유: 자동화된 워크플로우 실행 중'
    WHEN 'failed' THEN 'workflow_execution_failed: 워크플로우 실행 실패: HTTP 503'
    ELSE 'workflow_execution_error: 워크플로우 실행 중 오류 발생: no result within 10 minutes' END AS actions,
  CASE outcome WHEN 'error' THEN timestamp + INTERVAL 10 MINUTE ELSE timestamp + INTERVAL 30 SECOND END AS updated_at FROM told""")
def workflow_outcomes(spark, sf_dir):
    """State after workflow requests whose results came (those of high incidents
    failed) or, for every fifth anomaly, didn't come in time."""
    inc = IN.build_incidents(IN.dedup_anomalies(TB.anomalies(spark, sf_dir)))
    inc = inc.where(F.col("severity").isin("high", "critical")).withColumn("actions", F.array().cast(ACTIONS_TYPE))
    failed = F.col("severity") == "high"
    answers = inc.where(F.col("anomaly_id") % 5 != 0).select(
        "incident_id", (F.col("created_at") + F.expr("INTERVAL 30 SECONDS")).alias("result_at"), (~failed).alias("accepted"),
        F.when(~failed, F.col("incident_id")).alias("execution_id"), F.when(failed, F.lit("HTTP 503")).alias("error"))
    results = IN.workflow_results(inc.select("incident_id", F.col("created_at").alias("requested_at")), answers)
    s = IN.incident_state(IN.incident_events(inc, results))
    return s.select("incident_id", "status", _actions_text("actions").alias("actions"), "updated_at")


@query("detector_windows", O.with_ctes(O.LOGS) + f"""
SELECT window_start, feature, count(*) AS n FROM (
  SELECT window_start, unnest(list_filter(['log_level_' || log_level, 'component_' || component,
      'hour_' || CAST(hour(collected_at) AS VARCHAR), {_KW_DUCK}], lambda x: x IS NOT NULL)) AS feature
  FROM (SELECT *, time_bucket(INTERVAL 30 SECOND, collected_at, TIMESTAMP '1970-01-01') - to_seconds(30 * unnest(range(0, 10))) AS window_start FROM logs))
GROUP BY ALL""")
def detector_windows(spark, sf_dir):
    """Feature counts of 5-minute windows every 30 seconds of collection time: each
    row is counted in one 30-second pane, windows are sums of ten panes."""
    panes = FT.pane_counts(TB.logs(spark, sf_dir), "30 seconds", ts="collected_at")
    return FT.from_panes(panes, "5 minutes", "30 seconds").select("window_start", "feature", "n")
