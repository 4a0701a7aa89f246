import random

from pyspark.sql import functions as F

from loglens.operators.cooldown import cooldown, cooldown_fold_expr


def _frame(spark, rows):
    return spark.createDataFrame(
        [(i, det, f"2024-01-01 00:00:00", t, sev) for i, (det, t, sev) in enumerate(rows)],
        "anomaly_id long, detector_type string, base string, t long, severity string",
    ).select("anomaly_id", "detector_type", "severity",
             (F.col("base").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                      F.col("t").cast("decimal(18,6)"))).alias("timestamp"))


def test_trace(spark):
    trace = [(0, "medium", True), (30, "critical", False), (60, "critical", True), (100, "low", False),
             (359, "high", False), (360, "high", True), (419, "critical", False), (420, "critical", True)]
    df = _frame(spark, [("lstm", t, s) for t, s, _ in trace])
    got = {r["anomaly_id"]: r["sent"] for r in cooldown(df, chunk_seconds=3600).collect()}
    assert [got[i] for i in range(len(trace))] == [x[2] for x in trace]


def _fold(spark, df, gap, cgap):
    init, step = cooldown_fold_expr(gap, cgap)
    ev = df.select("detector_type", F.struct(
        F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("timestamp")).cast("double").alias("t"),
        F.col("anomaly_id").alias("id"), F.col("severity").alias("sev")).alias("e"))
    agg = ev.groupBy("detector_type").agg(F.array_sort(F.collect_list("e")).alias("es"))
    res = agg.select(F.explode(F.aggregate("es", init, step)["ids"]).alias("id")).collect()
    return {r["id"] for r in res}


def test_chunked_equals_fold(spark):
    rnd = random.Random(7)
    rows, t = [], 0
    for _ in range(600):
        t += rnd.choice([1, 5, 20, 40, 90, 200, 400, 1000])
        rows.append((rnd.choice(["a", "b"]), t, rnd.choice(["low", "medium", "high", "critical"])))
    df = _frame(spark, rows).persist()
    expect = _fold(spark, df, 300, 60)
    for chunk in [301, 1000, 7777, 100000]:
        got = {r["anomaly_id"] for r in cooldown(df, gap=300, critical_gap=60, chunk_seconds=chunk).where("sent").collect()}
        assert got == expect, chunk
