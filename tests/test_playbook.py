"""The playbook's analysis of related logs against a plain walk over them."""
import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from loglens.functions import constants as C
from loglens.plans import incidents as IN
from loglens.plans import playbook as PB

LOG = "event_id long, event_ts timestamp_ntz, timestamp string, log_level string, component string, message string, source_file string"


def test_analysis_counts_the_first_logs_once_a_second(spark):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    texts = ["Error and TIMEOUT", "denied", "", None, "all well", "invalid exception"]
    logs = []
    for i in range(9000):
        at = start + dt.timedelta(seconds=rng.randrange(6000) if i % 3 else 3000, microseconds=rng.randrange(10**6))
        logs.append((i, at, str(at), rng.choice(["INFO", "ERROR", "FATAL", None]), "c", rng.choice(texts), "f"))
    kinds = ["isolation_forest", "lstm", "bert", "other"]
    seconds = [1500] * 40 + [rng.randrange(-4000, 9000) for _ in range(80)] + [None]
    inc = [(f"i{j}", j, kinds[j % 4], None if s is None else start + dt.timedelta(seconds=s, microseconds=5)) for j, s in enumerate(seconds)]
    incidents = spark.createDataFrame(inc, "incident_id string, anomaly_id long, detector_type string, timestamp timestamp_ntz")
    at = IN.related_positions(incidents, spark.createDataFrame(logs, LOG))
    out = PB.analyse(incidents, at, 100)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
    got = {r.incident_id: r for r in out.collect()}
    assert len(got) == len(inc)
    ordered = sorted(logs, key=lambda x: (x[1].replace(microsecond=0), x[0]))
    for name, _, kind, when in inc:
        near = []
        if when is not None:
            s = when.replace(microsecond=0)
            near = [x for x in ordered if s - dt.timedelta(minutes=30) <= x[1].replace(microsecond=0) <= s + dt.timedelta(minutes=5)][:100]
        errors = [x[5] for x in near if x[3] in ("ERROR", "FATAL") and x[5]]
        want = []
        if kind == "isolation_forest" and near:
            level, n = min(Counter(x[3] or "unknown" for x in near).items(), key=lambda x: (-x[1], x[0]))
            want = [f"가장 많은 로그 레벨: {level} ({n}개)"] + [f"에러 메시지 {len(errors)}개 발견"] * bool(errors)
        elif kind == "lstm" and len(near) > 1:
            gap = (max(x[1] for x in near) - min(x[1] for x in near)) // dt.timedelta(seconds=1) / (len(near) - 1)
            want = [f"로그 간 평균 시간 간격: {round(gap, 1):.1f}초"]
        elif kind == "bert":
            found = {k: sum(k in (x[5] or "").lower() for x in near) for k in C.ANALYSIS_KEYWORDS}
            want = [f'키워드 "{k}": {n}개 발견' for k, n in found.items() if n]
        r = got[name]
        assert (r.detector_type, r.log_count, r.patterns) == (kind, len(near), want)
        assert r.error_samples == (errors[:3] if kind == "isolation_forest" and errors else None)
    assert Counter(r.log_count for r in got.values())[100] > 60 and min(r.log_count for r in got.values()) == 0
    assert incidents.where(F.col("timestamp").isNull()).count() == 1
