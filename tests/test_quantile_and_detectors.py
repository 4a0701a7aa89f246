import random

from pyspark.sql import functions as F

from loglens import catalog
from loglens.operators import cooldown as CD
from loglens.operators.clustering import message_summary
from loglens.operators.interval_join import first_in_interval
from loglens.operators.stats import quantile_by

SF = "/root/testdata/sf0.001"


def test_quantile_equals_percentile(spark):
    rng = random.Random(1)
    rows = [("a", rng.gauss(0, 1)) for _ in range(500)] + [("b", float(rng.randrange(3))) for _ in range(77)] + [("c", 5.0), ("d", None), ("e", 1e12), ("e", 1.0), ("e", 2.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    for q in (0.0, 0.05, 0.5, 0.95, 1.0):
        want = {r[0]: r[1] for r in df.groupBy("k").agg(F.percentile("x", q)).collect() if r[1] is not None}
        got = {r["k"]: r["threshold"] for r in quantile_by(df, ["k"], "x", q, bins=16).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1e-9 * max(1, abs(want[k])) for k in want)
    assert quantile_by(df.limit(0), ["k"], "x", 0.5).collect() == [] and quantile_by(df.limit(0), [], "x", 0.5).first()[0] is None


def test_oldest_events_of_an_interval(spark):
    rng = random.Random(2)
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    at = lambda c: base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(c).cast("decimal(18,6)"))
    ev = [(i, rng.choice([rng.randrange(200_000), 86_400])) for i in range(600)]
    pr = [(i, rng.choice([86_400, 87_000, rng.randrange(200_000)])) for i in range(60)] + [(99, None)]
    got = first_in_interval(spark.createDataFrame(pr, "p int, s int").select("p", at("s").alias("t")),
                            spark.createDataFrame(ev, "e int, s int").select("e", at("s").alias("u")), "t", "u", ["e"], 1800, 300, 7).collect()
    want = set()
    for p, s in pr:
        if s is None:
            continue
        inside = sorted((u, e) for e, u in ev if s - 1800 <= u <= s + 300)
        want |= {(p, e, r + 1, len(inside)) for r, (_, e) in enumerate(inside[:7])}
    assert {(r["p"], r["e"], r["rank"], r["total"]) for r in got} == want and len(got) == len(want)


def test_many_alerts_a_second(spark):
    sev = F.when(F.col("id") % 7 == 0, "critical").when(F.col("id") % 5 == 0, "low").otherwise("high")
    ev = spark.range(20_000).select(
        F.col("id").alias("anomaly_id"), F.lit("d").alias("detector_type"), sev.alias("severity"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 700).cast("decimal(18,6)"))).alias("timestamp"))
    got = {r["anomaly_id"] for r in CD.cooldown(ev).where("sent").collect()}
    last, want = None, set()
    for t, i in sorted((i % 700, i) for i in range(20_000)):
        crit = i % 7 == 0
        if not crit and i % 5 == 0:
            continue
        if last is None or t - last >= (60 if crit else 300):
            last = t
            want.add(i)
    assert got == want


def test_detector_records_reach_the_alerts(spark):
    ids = [r["anomaly_id"] for r in catalog.QUERIES["detector_records"](spark, SF).collect()]
    assert len(ids) == len(set(ids)) and None not in ids
    assert catalog.QUERIES["detector_alerts"](spark, SF).where("sent").count() > 0
    spark.catalog.clearCache()


def test_no_messages_no_record(spark):
    assert message_summary(spark.createDataFrame([], "distance double, is_anomaly boolean")).collect() == []
