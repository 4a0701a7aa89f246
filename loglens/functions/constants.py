"""Fixed values that must equal the reference's for equal results.

Fixed values (kept as plain text, in the reference's order):
"""

# Error keywords counted by the window and minute features (case-insensitive substring).
ERROR_KEYWORDS = ["error", "exception", "fail", "failed", "timeout", "denied"]

# Keywords counted by the playbook's related-log analysis of message-detector incidents.
ANALYSIS_KEYWORDS = ["error", "exception", "failed", "timeout", "denied", "invalid"]

# Log levels treated as errors by the playbook analysis.
ERROR_LEVELS = ["ERROR", "FATAL", "CRITICAL"]

# Text format of timestamps in log lines and records.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Parser failure text (message of the index error raised on short lines).
PARSE_ERROR_TEXT = "list index out of range"

# Detector display names (alerts and incident titles).
DETECTOR_NAMES = {
    "isolation_forest": "구조화 데이터 분석",
    "lstm": "시퀀스 패턴 분석",
    "bert": "로그 메시지 의미 분석",
}

# Slack attachment colour per severity, and the fallback colour.
SEVERITY_COLORS = {
    "low": "#36a64f",
    "medium": "#ffd700",
    "high": "#ff9900",
    "critical": "#ff0000",
}
DEFAULT_COLOR = "#777777"

# Texts of alerts and their channels.
ALERT_TEXT = "에서 비정상 로그 패턴이 감지되었습니다."
SUBJECT_HEAD = " 보안 경고: "
SUBJECT_TAIL = "에서 비정상 패턴 감지"
SEVERITY_LABEL = "심각도"
DETECTED_LABEL = "탐지 시간"
SLACK_CHANNEL = "#security-alerts"
SLACK_USER = "보안 알림 봇"
SLACK_ICON = ":warning:"
SLACK_PRETEXT = "보안 알림이 발생했습니다!"
SLACK_FOOTER = "AI 기반 로그 이상 탐지 시스템"
SLACK_FOOTER_ICON = "https://platform.slack-edge.com/img/default_application_icon.png"
EMAIL_TITLE = "보안 알림"
EMAIL_TIME_LABEL = "시간"
EMAIL_TABLE_TITLE = "상세 정보"
EMAIL_TABLE_HEAD = ["항목", "값"]
EMAIL_FOOTER = "이 알림은 AI 기반 로그 이상 탐지 시스템에서 자동으로 생성되었습니다."

# Text colour of the severity in mails.
EMAIL_COLORS = {
    "low": "#28a745",
    "medium": "#ffc107",
    "high": "#fd7e14",
    "critical": "#dc3545",
}

# Email subject tags per severity, and the fallback tag.
SUBJECT_TAGS = {"critical": "[긴급]", "high": "[중요]"}
DEFAULT_SUBJECT_TAG = "[알림]"

# Severity thresholds (all comparisons strict).
FOREST_SCORE_CUTS = [(-0.7, "critical"), (-0.5, "high"), (-0.3, "medium")]
LSTM_ERROR_RATIO_CUTS = [(2.0, "critical"), (1.5, "high"), (1.2, "medium")]
LSTM_ANOMALY_RATIO_CUTS = [(0.5, "critical"), (0.3, "high"), (0.1, "medium")]
BERT_ANOMALY_RATIO_CUTS = [(0.5, "critical"), (0.3, "high"), (0.1, "medium")]

# Alert cooldown in seconds: critical alerts need 60 s since the last alert of
# the same detector, other alerts need 300 s; low severity never alerts.
CRITICAL_COOLDOWN_SECONDS = 60
COOLDOWN_SECONDS = 300

# Incident-related log window: [ts - 30 min, ts + 5 min], oldest 1000 logs,
# the playbook search keeps 100; context keeps 10 samples; analysis keeps 3 error samples.
RELATED_BEFORE_MINUTES = 30
RELATED_AFTER_MINUTES = 5
RELATED_LOG_LIMIT = 1000
PLAYBOOK_LOG_LIMIT = 100
CONTEXT_SAMPLES = 10
ERROR_SAMPLES = 3

# Detector settings.
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_CONTAMINATION = 0.05
SEQ_LENGTH = 10
VALIDATION_SPLIT = 0.2
THRESHOLD_PERCENTILE = 0.95
KMEANS_K = 10
SEED = 42
