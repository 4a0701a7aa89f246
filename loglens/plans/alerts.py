"""Alerting: severity → cooldown → channel outbox with message, details and payloads.

Every evaluated anomaly is decided once, in event-time order per detector
(see :mod:`loglens.operators.cooldown`).  Sent alerts go to an ``alerts``
outbox table: one row per channel (Slack always, email for high/critical).
Delivery to webhooks/SMTP is left to a consumer of that table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.parse import epoch_seconds, ts_text
from ..functions.severity import severity
from ..operators.cooldown import cooldown


def _map_lookup(mapping: dict, key: Column, default: Column) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[key], default)


def detector_name_upper(det: Column) -> Column:
    """Display name looked up by the upper-cased type; unknown types show upper-cased."""
    up = F.upper(F.coalesce(det, F.lit("unknown")))
    return _map_lookup({k.upper(): v for k, v in C.DETECTOR_NAMES.items()}, up, up)


def fmt4(c: Column) -> Column:
    return F.format_string("%.4f", F.coalesce(c, F.lit(0.0)))


def details(det: Column | None = None) -> Column:
    """Ordered (title, value) pairs per detector type."""
    det = det if det is not None else F.col("detector_type")
    d = lambda t, v: F.struct(F.lit(t).alias("title"), v.cast("string").alias("value"))
    n0 = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    common = [d("탐지 시간", F.coalesce(ts_text(F.col("timestamp")), F.lit("N/A"))),
              d("탐지기 유형", F.coalesce(det, F.lit("unknown")))]
    window = d("시간 범위", F.concat(n0("time_window_minutes"), F.lit("분")))
    forest = [d("이상 점수", fmt4(F.col("anomaly_score"))), d("로그 수", n0("log_count")), window]
    lstm = [d("평균 오차", fmt4(F.col("mean_error"))), d("최대 오차", fmt4(F.col("max_error"))),
            d("이상 시퀀스", F.concat(n0("anomaly_count"), F.lit("/"), n0("total_sequences"))), window]
    bert = [d("평균 거리", fmt4(F.col("mean_distance"))), d("최대 거리", fmt4(F.col("max_distance"))),
            d("이상 로그", F.concat(n0("anomaly_count"), F.lit("/"), n0("total_logs"))), window]
    return (F.when(det == "isolation_forest", F.array(*common, *forest))
             .when(det == "lstm", F.array(*common, *lstm))
             .when(det == "bert", F.array(*common, *bert))
             .otherwise(F.array(*common)))


def details_text(col: Column) -> Column:
    return F.array_join(F.transform(col, lambda x: F.concat(x["title"], F.lit(": "), x["value"])), "\n")


def alert_message(det: Column) -> Column:
    return F.concat(detector_name_upper(det), F.lit(C.ALERT_TEXT))


def email_subject(det: Column, sev: Column) -> Column:
    tag = _map_lookup(C.SUBJECT_TAGS, sev, F.lit(C.DEFAULT_SUBJECT_TAG))
    return F.concat(tag, F.lit(C.SUBJECT_HEAD), detector_name_upper(det), F.lit(C.SUBJECT_TAIL))


def slack_color(sev: Column) -> Column:
    return _map_lookup(C.SEVERITY_COLORS, sev, F.lit(C.DEFAULT_COLOR))


def slack_payload(message: Column, sev: Column, det_arr: Column, sent_at: Column, channel: str = C.SLACK_CHANNEL) -> Column:
    """JSON of one message: severity and time first, then the details."""
    field = lambda title, value: F.struct(title.alias("title"), value.alias("value"), F.lit(True).alias("short"))
    fields = F.concat(F.array(field(F.lit(C.SEVERITY_LABEL), F.upper(sev)), field(F.lit(C.DETECTED_LABEL), ts_text(sent_at))),
                      F.transform(det_arr, lambda x: field(x["title"], x["value"])))
    parts = {"fallback": message, "pretext": F.lit(C.SLACK_PRETEXT), "title": message, "color": slack_color(sev), "fields": fields,
             "footer": F.lit(C.SLACK_FOOTER), "footer_icon": F.lit(C.SLACK_FOOTER_ICON), "ts": epoch_seconds(sent_at)}
    head = {"channel": F.lit(channel), "username": F.lit(C.SLACK_USER), "icon_emoji": F.lit(C.SLACK_ICON),
            "attachments": F.array(F.struct(*[v.alias(k) for k, v in parts.items()]))}
    return F.to_json(F.struct(*[v.alias(k) for k, v in head.items()]))


def escaped(text: Column) -> Column:
    """Text that is safe inside HTML elements and attributes."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


#: Mail body: ``{}`` stands for a value.
MAIL_STYLE = "body{font-family:sans-serif}td,th{border:1px solid #ddd;padding:8px}" + "".join(f".{k}{{color:{v}}}" for k, v in C.EMAIL_COLORS.items())
MAIL_ROW = "<tr><td>{}</td><td>{}</td></tr>"
MAIL_TABLE = (f"<h3>{C.EMAIL_TABLE_TITLE}</h3><table><tr>" + "".join(f"<th>{h}</th>" for h in C.EMAIL_TABLE_HEAD) + "</tr>{}</table>")
MAIL_BODY = (f"<html><head><style>{MAIL_STYLE}</style></head><body><h2>{C.EMAIL_TITLE}</h2>"
             f"<p>{C.SEVERITY_LABEL}: <b class=\"{{}}\">{{}}</b></p><p>{C.EMAIL_TIME_LABEL}: {{}}</p><p>{{}}</p>{{}}<hr><p>{C.EMAIL_FOOTER}</p></body></html>")


def filled(template: str, *values: Column) -> Column:
    texts = template.split("{}")
    return F.concat(F.lit(texts[0]), *[c for v, t in zip(values, texts[1:]) for c in (v, F.lit(t))])


def email_html(message: Column, sev: Column, det_arr: Column, sent_at: Column) -> Column:
    rows = F.array_join(F.transform(det_arr, lambda x: filled(MAIL_ROW, escaped(x["title"]), escaped(x["value"]))), "")
    table = F.when(F.size(det_arr) > 0, filled(MAIL_TABLE, rows)).otherwise(F.lit(""))
    return filled(MAIL_BODY, escaped(sev), escaped(F.upper(sev)), ts_text(sent_at), escaped(message), table)


def evaluate_alerts(anomalies: DataFrame, gap: float = C.COOLDOWN_SECONDS,
                    critical_gap: float = C.CRITICAL_COOLDOWN_SECONDS, chunk_seconds: int = 86400) -> DataFrame:
    """Anomalous records with ``severity`` and ``sent``."""
    a = anomalies.where(F.col("is_anomaly")).withColumn("severity", severity())
    return cooldown(a, gap=gap, critical_gap=critical_gap, chunk_seconds=chunk_seconds)


def alert_outbox(evaluated: DataFrame, sent_at: Column | None = None) -> DataFrame:
    """One row per (sent alert, channel) with message, details and payload."""
    sent_at = sent_at if sent_at is not None else F.col("timestamp")
    s = evaluated.where(F.col("sent"))
    det = F.col("detector_type")
    s = s.select("*", details(det).alias("details"), alert_message(det).alias("message"),
                 sent_at.cast("timestamp_ntz").alias("sent_at"))
    chans = F.when(F.col("severity").isin("high", "critical"), F.array(F.lit("slack"), F.lit("email"))) \
             .otherwise(F.array(F.lit("slack")))
    s = s.withColumn("channel", F.explode(chans))
    payload = F.when(F.col("channel") == "slack",
                     slack_payload(F.col("message"), F.col("severity"), F.col("details"), F.col("sent_at"))) \
               .otherwise(email_html(F.col("message"), F.col("severity"), F.col("details"), F.col("sent_at")))
    return s.select("anomaly_id", "detector_type", "severity", "message", "details", "channel",
                    F.when(F.col("channel") == "email", email_subject(det, F.col("severity"))).alias("subject"),
                    payload.alias("payload"), "sent_at")
