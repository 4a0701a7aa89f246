"""Incident-response playbook as one batch job keyed by ``incident_id``.

route (severity) → notices (SMS / email outbox) → related logs (first 100 of
the interval) → per-detector analysis (patterns, error samples) → ticket
→ response decision (context has ERROR level / error samples / default) →
close (status ``responded`` + ``automated_response`` action, appended).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.parse import epoch_seconds, ts_text
from ..operators.interval_join import Positions, first_summary


def route(sev: Column) -> Column:
    return (F.when(sev == "critical", "urgent_notice").when(sev == "high", "normal_notice")
             .otherwise("collect"))


def truncate(s: Column, n: int = 100, end: str = "...") -> Column:
    """Template-style truncate: longer than n → first n - len(end) chars + end."""
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n - len(end)), F.lit(end))).otherwise(s)


def notices(incidents: DataFrame) -> DataFrame:
    """SMS for critical, email for high (one row each)."""
    r = route(F.col("severity"))
    sms = F.concat(F.lit("긴급 보안 경고: "), F.col("title"), F.lit(" - "), truncate(F.col("description")))
    body = F.concat(F.col("description"), F.lit("\n\n심각도: "), F.col("severity"),
                    F.lit("\n탐지 시간: "), ts_text(F.col("timestamp")))
    return (incidents.where(r != "collect")
            .select("incident_id",
                    F.when(r == "urgent_notice", "sms").otherwise("email").alias("channel"),
                    F.when(r == "normal_notice", F.concat(F.lit("보안 경고: "), F.col("title"))).alias("subject"),
                    F.when(r == "urgent_notice", sms).otherwise(body).alias("body")))


def analyse(incidents: DataFrame, at: Positions, limit: int = C.PLAYBOOK_LOG_LIMIT) -> DataFrame:
    """Per incident: log_count, patterns array<string>, error_samples array<string> (or null).

    The playbook's own search keeps the first ``limit`` related logs.  They are counted
    by chunks of positions, once for all incidents of a second: no row is made for a
    pair of incident and log.
    """
    lvl = F.coalesce(F.col("log_level"), F.lit("unknown"))
    msg = F.coalesce(F.col("message"), F.lit(""))
    is_err = F.col("log_level").isin(*C.ERROR_LEVELS) & (msg != "")
    kw = {f"kw_{i}": F.lower(msg).contains(k) for i, k in enumerate(C.ANALYSIS_KEYWORDS)}
    i = incidents.select("incident_id", "detector_type", epoch_seconds(F.col("timestamp")).alias("_ps"))
    found = first_summary(at, {"_levels": lvl}, {"m": msg}, C.ERROR_SAMPLES, limit, {"n_err": is_err, **kw}, F.col("event_ts"), is_err, i)
    most = F.array_min(F.transform(F.map_entries("_levels"), lambda x: F.struct((-x["value"]).alias("nc"), x["key"].alias("lvl"))))
    j = i.join(found.select("_ps", F.col("_count").alias("log_count"), most.alias("_m"), "n_err", F.col("_least").alias("t_min"),
                            F.col("_greatest").alias("t_max"), F.col("_rows").alias("_samples"), *kw), "_ps", "left")
    n = F.coalesce(F.col("log_count"), F.lit(0))
    det = F.col("detector_type")
    mode_p = F.when(F.col("_m").isNotNull(), F.concat(
        F.lit("가장 많은 로그 레벨: "), F.col("_m.lvl"), F.lit(" ("), (-F.col("_m.nc")).cast("string"), F.lit("개)")))
    err_p = F.when(F.col("n_err") > 0, F.concat(F.lit("에러 메시지 "), F.col("n_err").cast("string"), F.lit("개 발견")))
    secs = F.timestamp_diff("SECOND", F.col("t_min"), F.col("t_max"))
    gap_p = F.when(n >= 2, F.concat(F.lit("로그 간 평균 시간 간격: "),
                                    F.format_string("%.1f", F.bround(secs / (n - 1).cast("double"), 1)), F.lit("초")))
    kw_p = [F.when(F.col(f"kw_{i}") > 0, F.concat(F.lit(f'키워드 "{k}": '), F.col(f"kw_{i}").cast("string"),
                                                 F.lit("개 발견"))) for i, k in enumerate(C.ANALYSIS_KEYWORDS)]
    keep = lambda *xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    patterns = (F.when(det == "isolation_forest", keep(mode_p, err_p))
                 .when(det == "lstm", keep(gap_p))
                 .when(det == "bert", keep(*kw_p))
                 .otherwise(F.array().cast("array<string>")))
    samples = F.when((det == "isolation_forest") & (F.col("n_err") > 0),
                     F.transform(F.col("_samples"), lambda x: x["m"]))
    return j.select("incident_id", "detector_type", n.alias("log_count"), patterns.alias("patterns"),
                    samples.alias("error_samples"))


def tickets(incidents: DataFrame, analysis: DataFrame) -> DataFrame:
    j = (incidents.select("incident_id", "title", "description", "severity")
         .join(analysis.select("incident_id", "log_count", "patterns"), "incident_id", "left"))
    lines = F.array_join(F.transform(F.coalesce(F.col("patterns"), F.array().cast("array<string>")),
                                     lambda p: F.concat(F.lit("- "), p, F.lit("\n"))), "")
    desc = F.concat(F.col("description"), F.lit("\n\n분석 결과:\n"), lines,
                    F.lit("\n\n관련 로그 수: "), F.coalesce(F.col("log_count"), F.lit(0)).cast("string"), F.lit("개"))
    urg = F.when(F.col("severity") == "critical", 1).when(F.col("severity") == "high", 2).otherwise(3)
    return j.select("incident_id", F.col("title").alias("short_description"), desc.alias("description"),
                    urg.alias("urgency"), F.lit("security").alias("category"))


RESPONSES = {
    "log_level_based_response": "대상 시스템 상태 확인 및 로그 패턴 분석 완료",
    "error_message_based_response": "에러 메시지 분석 및 관련 서비스 상태 점검 완료",
    "default_response": "기본 모니터링 및 로그 수집 강화",
}


def decide(enriched: DataFrame, analysis: DataFrame) -> DataFrame:
    j = enriched.select("incident_id", "context").join(analysis.select("incident_id", "error_samples"),
                                                       "incident_id", "left")
    has_error_level = F.coalesce(F.map_contains_key(F.col("context.log_level_stats"), F.lit("ERROR")), F.lit(False))
    act = (F.when(has_error_level, "log_level_based_response")
            .when(F.col("error_samples").isNotNull(), "error_message_based_response")
            .otherwise("default_response"))
    m = F.create_map(*[x for k, v in RESPONSES.items() for x in (F.lit(k), F.lit(v))])
    return j.select("incident_id", act.alias("action"), F.lit(True).alias("completed"), m[act].alias("details"))


def closes(decisions: DataFrame, event_time: Column) -> DataFrame:
    return decisions.select("incident_id", event_time.cast("timestamp_ntz").alias("event_time"))
