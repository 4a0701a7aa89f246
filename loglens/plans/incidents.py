"""Incident response: dedup → severity → build → enrich with related logs →
event-sourced state, upserts/partial updates, workflow-request outbox.

All steps are DataFrame jobs over the whole anomaly table.  Related logs come
from one numbering of the logs for all incidents at once (not one search per
incident), oldest first.  The context counts the first 1000 of them, and takes its
10 samples, by chunks of positions, and so does the playbook for the first 100 of
serious incidents; rows are looked up only where they are the result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.parse import epoch_seconds, from_zoned, ts_text
from ..functions.severity import severity
from ..operators.dedup import keep_first
from ..operators.interval_join import Positions, first_rows, first_summary, positions
from ..session import checkpointed
from ..sources.ingest import stored_rows


def _name(det: Column) -> Column:
    m = F.create_map(*[x for k, v in C.DETECTOR_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[det], det)


def dedup_key(df: DataFrame) -> Column:
    """md5 of ``timestamp_detector[_score | _mean_error]`` (score preferred)."""
    extra = F.coalesce(F.col("anomaly_score").cast("string"), F.col("mean_error").cast("string"))
    return F.md5(F.concat_ws("_", ts_text(F.col("timestamp")), F.col("detector_type"), extra))


def dedup_anomalies(anoms: DataFrame) -> DataFrame:
    """First record per (timestamp, detector, score-or-error) among anomalous
    records; processing order is newest first, so within a key (same
    timestamp) the lowest ``anomaly_id`` wins.  Aggregate-based: no hot key
    lands in one task.  Adds ``severity``; low keys are kept here and dropped
    by :func:`build_incidents` (their key still counts as processed)."""
    a = anoms.where(F.col("is_anomaly"))
    a = a.withColumn("_k1", F.coalesce(F.col("anomaly_score"), F.col("mean_error"))) \
         .withColumn("_k2", F.when(F.col("anomaly_score").isNotNull(), "s")
                              .when(F.col("mean_error").isNotNull(), "e"))
    first = keep_first(a, ["timestamp", "detector_type", "_k1", "_k2"], ["anomaly_id"], count_col=None)
    return first.drop("_k1", "_k2").withColumn("severity", severity())


def incident_id(anomaly: DataFrame) -> Column:
    """md5 of time, detector and record id; a record without an id goes by its
    score or error instead, so two of one second keep apart."""
    extra = F.coalesce(F.col("anomaly_score").cast("string"), F.col("mean_error").cast("string"), F.lit(""))
    own = F.coalesce(F.col("anomaly_id").cast("string"), F.concat(F.lit("no id "), extra))
    return F.md5(F.concat_ws("_", ts_text(F.col("timestamp")), F.col("detector_type"), own))


def title(det: Column) -> Column:
    return F.concat(_name(det), F.lit("에서 발견된 로그 이상 패턴"))


def description(det: Column) -> Column:
    f4 = lambda c: F.format_string("%.4f", F.coalesce(F.col(c), F.lit(0.0)))
    n0 = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    nl = F.lit("\n")
    head = F.concat(F.lit("탐지 시간: "), ts_text(F.col("timestamp")), nl,
                    F.lit("탐지기 유형: "), det, nl, nl)
    window = F.concat(F.lit("시간 범위: "), n0("time_window_minutes"), F.lit("분\n"))
    forest = F.concat(F.lit("이상 점수: "), f4("anomaly_score"), nl,
                      F.lit("분석된 로그 수: "), n0("log_count"), nl, window)
    lstm = F.concat(F.lit("평균 오차: "), f4("mean_error"), nl, F.lit("최대 오차: "), f4("max_error"), nl,
                    F.lit("이상 시퀀스: "), n0("anomaly_count"), F.lit("/"), n0("total_sequences"), nl, window)
    bert = F.concat(F.lit("평균 거리: "), f4("mean_distance"), nl, F.lit("최대 거리: "), f4("max_distance"), nl,
                    F.lit("이상 로그: "), n0("anomaly_count"), F.lit("/"), n0("total_logs"), nl, window)
    body = (F.when(det == "isolation_forest", forest).when(det == "lstm", lstm)
             .when(det == "bert", bert).otherwise(F.lit("")))
    return F.concat(head, body)


def build_incidents(deduped: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Non-low deduplicated anomalies → incident rows (status ``new``)."""
    created = created_at if created_at is not None else F.col("timestamp")
    det = F.coalesce(F.col("detector_type"), F.lit("unknown"))
    return (deduped.where(F.col("severity") != "low")
            .select(incident_id(deduped).alias("incident_id"), "anomaly_id", title(det).alias("title"),
                    description(det).alias("description"), F.lit("new").alias("status"), "severity",
                    det.alias("detector_type"), "timestamp", created.cast("timestamp_ntz").alias("created_at"),
                    *[c for c in deduped.columns if c not in
                      ("anomaly_id", "severity", "detector_type", "timestamp")]))


LOG_COLUMNS = ("event_id", "event_ts", "timestamp", "log_level", "component", "message", "source_file")


def related_positions(incidents: DataFrame, logs: DataFrame, limit: int = C.RELATED_LOG_LIMIT,
                      before_min: int = C.RELATED_BEFORE_MINUTES, after_min: int = C.RELATED_AFTER_MINUTES,
                      log_cols: tuple = LOG_COLUMNS, keep=lambda df: df, cut=lambda df: df) -> Positions:
    """Where the oldest ``limit`` logs in [ts - before, ts + after] of each incident
    lie among all logs.  Null incident times match nothing."""
    probes = incidents.select("incident_id", "anomaly_id", F.col("timestamp").alias("_its"))
    return positions(probes, logs.select(*log_cols), "_its", "event_ts", ["event_id"], before_min * 60, after_min * 60, limit, keep, cut)


def related_logs(at: Positions, first: int, incidents: DataFrame | None = None) -> DataFrame:
    """(incident_id, anomaly_id, log columns..., rank, related_logs_total) of the
    ``first`` related logs of each incident, or of the given ones; the total counts
    all logs of the interval, past any limit."""
    probes = at.probes if incidents is None else at.probes.join(incidents.select("incident_id"), "incident_id", "left_semi")
    return first_rows(at, first, probes, total_col="related_logs_total").drop("_its")


def context(at: Positions, samples: int = C.CONTEXT_SAMPLES, by_second: bool = False) -> DataFrame:
    """Per incident with related logs: their count (at most the limit of ``at``),
    the uncapped total, level and component counts (missing → 'unknown') and the
    first ``samples`` logs, made once for all incidents of a second.  With
    ``by_second`` one row a second (``_ps``), which :func:`enrich` takes as well."""
    known = {"log_level_stats": F.coalesce("log_level", F.lit("unknown")), "component_stats": F.coalesce("component", F.lit("unknown"))}
    shown = {c: F.col(c) for c in ("timestamp", "log_level", "component", "message", "source_file")}
    per = first_summary(at, known, shown, samples).select(
        "_ps", F.col("_total").alias("related_logs_total"), F.struct(
            F.col("_count").alias("related_logs_count"), *known, F.col("_rows").alias("log_samples")).alias("context"))
    return per if by_second else at.probes.select("incident_id", "_ps").join(per, "_ps").drop("_ps")


def action(action_type: str | Column, desc: Column, ts: Column, status: str = "completed") -> Column:
    at = F.lit(action_type) if isinstance(action_type, str) else action_type
    return F.struct(at.alias("action_type"), desc.alias("description"), F.lit(status).alias("status"),
                    ts.cast("timestamp_ntz").alias("timestamp"))


def enrich(incidents: DataFrame, ctx: DataFrame) -> DataFrame:
    """Attach context (by incident or by second); add a ``context_enrichment`` action
    where logs were found."""
    if "_ps" in ctx.columns:
        j = incidents.withColumn("_ps", epoch_seconds(F.col("timestamp"))).join(ctx, "_ps", "left").drop("_ps")
    else:
        j = incidents.join(ctx, "incident_id", "left")
    n = F.col("context.related_logs_count")
    act = action("context_enrichment",
                 F.concat(F.lit("관련 로그 "), n.cast("string"), F.lit("개를 추가하여 컨텍스트 정보 보강")),
                 F.col("created_at"))
    return j.withColumn("actions", F.when(n > 0, F.array(act)).otherwise(F.array().cast(
        "array<struct<action_type:string,description:string,status:string,timestamp:timestamp_ntz>>")))


# ---------------------------------------------------------------- event-sourced state

def workflow_requests(incidents: DataFrame) -> DataFrame:
    """High/critical incidents → workflow-request outbox.  The JSON argument is
    the whole incident record as created; times as ``yyyy-MM-dd HH:mm:ss``."""
    hc = incidents.where(F.col("severity").isin("high", "critical"))
    head = ["incident_id", "title", "description", "status", "severity", "detector_type"]
    data = [c for c in hc.columns if c not in (*head, "timestamp", "created_at", "context", "actions")]
    arg = F.to_json(F.struct(
        *head, ts_text(F.col("timestamp")).alias("timestamp"), ts_text(F.col("created_at")).alias("created_at"),
        ts_text(F.col("created_at")).alias("updated_at"), F.struct(*data).alias("anomaly_data"),
        F.array().cast("array<string>").alias("actions")))
    return hc.select("incident_id", "severity", arg.alias("execution_argument"))


def workflow_results(requests: DataFrame, results: DataFrame, within: str = "10 minutes", zoned_times: bool = False) -> DataFrame:
    """(incident_id, event_time, outcome, execution_id, error): what became of each
    workflow request (incident_id, requested_at).  A result (incident_id,
    result_at, accepted, execution_id, error) counts if it comes within that time
    of its request; a request without one has the outcome ``error`` at its end.
    Batch tables or streams with watermarks on both times (``zoned_times``)."""
    end = F.col("requested_at") + F.expr(f"INTERVAL {within}")
    r = results.select(F.col("incident_id").alias("_id"), "result_at", "accepted", "execution_id", F.col("error").alias("_error"))
    j = requests.join(r, (F.col("incident_id") == F.col("_id")) & (F.col("result_at") >= F.col("requested_at")) & (F.col("result_at") <= end), "left")
    at = F.coalesce("result_at", end)
    none = F.col("_id").isNull()
    return j.select("incident_id", (from_zoned(at) if zoned_times else at).alias("event_time"),
                    F.when(none, "error").when(F.col("accepted"), "accepted").otherwise("failed").alias("outcome"), "execution_id",
                    F.when(none, F.lit("no result within " + within)).otherwise(F.col("_error")).alias("error"))


def incident_events(enriched: DataFrame, results: DataFrame | None = None,
                    closes: DataFrame | None = None) -> DataFrame:
    """Event log rows (incident_id, event_time, seq, status, action).

    seq 0 creation (status new), 1 context action, then for accepted workflow
    results a ``workflow_execution`` action and a status change to
    ``in_progress``; failed results add ``workflow_execution_failed``, requests that
    came to nothing ``workflow_execution_error`` (``outcome``); playbook closes set ``responded`` with an ``automated_response`` action.
    """
    t = F.col("created_at")
    created = enriched.select("incident_id", t.alias("event_time"), F.lit(0).alias("seq"),
                              F.lit("new").alias("status"), F.lit(None).cast(
                                  "struct<action_type:string,description:string,status:string,timestamp:timestamp_ntz>").alias("action"))
    ctx = enriched.where(F.size("actions") > 0).select(
        "incident_id", t.alias("event_time"), F.lit(1).alias("seq"), F.lit(None).cast("string").alias("status"),
        F.get("actions", F.lit(0)).alias("action"))
    parts = [created, ctx]
    if results is not None:
        if "outcome" not in results.columns:
            results = results.withColumn("outcome", F.when(F.col("accepted"), "accepted").otherwise("failed"))
        ok = results.where(F.col("outcome") == "accepted")
        parts.append(ok.select("incident_id", F.col("event_time"), F.lit(2).alias("seq"),
                               F.lit(None).cast("string").alias("status"),
                               action("workflow_execution", F.concat(F.lit("워크플로우 실행 시작 (실행 ID: "),
                                                                     F.col("execution_id"), F.lit(")")),
                                      F.col("event_time")).alias("action")))
        parts.append(ok.select("incident_id", F.col("event_time"), F.lit(3).alias("seq"), F.lit("in_progress").alias("status"),
                               action("status_change", F.lit("인시던트 상태가 'in_progress'(으)로 변경되었습니다. 사유: 자동화된 워크플로우 실행 중"),
                                      F.col("event_time")).alias("action")))
        bad = results.where(F.col("outcome") != "accepted")
        failed = F.col("outcome") == "failed"
        parts.append(bad.select("incident_id", F.col("event_time"), F.lit(2).alias("seq"),
                                F.lit(None).cast("string").alias("status"),
                                action(F.when(failed, "workflow_execution_failed").otherwise("workflow_execution_error"),
                                       F.concat(F.when(failed, "워크플로우 실행 실패: ").otherwise("워크플로우 실행 중 오류 발생: "),
                                                F.coalesce(F.col("error"), F.lit(""))),
                                       F.col("event_time")).alias("action")))
    if closes is not None:
        parts.append(closes.select("incident_id", F.col("event_time"), F.lit(4).alias("seq"),
                                   F.lit("responded").alias("status"),
                                   action("automated_response", F.lit("자동화된 대응 수행 완료"),
                                          F.col("event_time")).alias("action")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def incident_state(events: DataFrame) -> DataFrame:
    """Latest state per incident: last non-null status, actions in order, updated_at."""
    ordered = F.struct("event_time", "seq")
    return events.groupBy("incident_id").agg(
        F.max_by(F.col("status"), F.when(F.col("status").isNotNull(), ordered)).alias("status"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("action").isNotNull(),
                                                       F.struct(F.col("event_time"), F.col("seq"), F.col("action"))))),
                    lambda x: x["action"]).alias("actions"),
        F.max("event_time").alias("updated_at"))


def upsert(old: DataFrame, new: DataFrame, key: str = "incident_id", version: str = "updated_at") -> DataFrame:
    """Keep the latest version per key (new wins ties)."""
    o = old.withColumn("_src", F.lit(0))
    n = new.withColumn("_src", F.lit(1))
    u = o.unionByName(n, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.col(version).desc_nulls_last(), F.col("_src").desc())
    return u.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_src")


#: Buckets of the stored incident table, by hash of the id.
TABLE_BUCKETS = 256


def upsert_table(path: str, new: DataFrame, key: str = "incident_id", version: str = "updated_at", buckets: int = TABLE_BUCKETS) -> None:
    """Upsert ``new`` into the table at ``path``, which is partitioned by a bucket
    of the key: only buckets that hold a new key are read and written again, the
    others keep their files.  Of several versions of a key the latest stays; a
    repeated call changes nothing."""
    spark = new.sparkSession
    rows = checkpointed(new.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")))
    touched = [r[0] for r in rows.select("bucket").distinct().collect()]       # at most ``buckets``
    if not touched:
        return
    old = stored_rows(spark, path)
    merged = upsert(rows.limit(0) if old is None else old.where(F.col("bucket").isin(touched)), rows, key, version)
    (checkpointed(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))


def partial_update(old: DataFrame, doc: DataFrame, key: str = "incident_id") -> DataFrame:
    """Fields present (non-null) in ``doc`` replace the stored ones; others stay.
    ``actions`` in the doc are appended (the history is kept)."""
    d = doc.select(key, *[F.col(c).alias(f"_new_{c}") for c in doc.columns if c != key])
    j = old.join(d, key, "left")
    cols = []
    for c in old.columns:
        if c == key or f"_new_{c}" not in j.columns:
            cols.append(F.col(c))
        elif c == "actions":
            cols.append(F.when(F.col("_new_actions").isNotNull(),
                               F.concat(F.coalesce(F.col("actions"), F.array()), F.col("_new_actions")))
                         .otherwise(F.col("actions")).alias("actions"))
        else:
            cols.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
    return j.select(*cols)
