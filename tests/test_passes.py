"""Running passes against the batch operators over the same rows."""
import pytest
from pyspark.sql import functions as F

from loglens.operators import features as FT
from loglens.plans import alerts as AL
from loglens.plans import incidents as IN
from loglens.sources import tables as TB
from loglens.streaming import passes as P


def available(query):
    query.awaitTermination(300)
    assert query.exception() is None


def parts(df, path, conditions):
    """Files of ``df``, one for each condition; a stream reads them one by one."""
    for c in conditions:
        df.where(c).coalesce(1).write.mode("append").parquet(path)


def one_by_one(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def test_incidents_once_for_overlapping_and_replayed_polls(spark, sf_small, tmp_path):
    src, root, ckpt = (str(tmp_path / x) for x in ("src", "out", "c"))
    anomalies = TB.anomalies(spark, sf_small).where("anomaly_id < 300").persist()
    logs = TB.logs(spark, sf_small).persist()
    parts(anomalies, src, ["anomaly_id < 150", "anomaly_id BETWEEN 100 AND 220", "anomaly_id < 300"])
    available(P.incident_query(one_by_one(spark, anomalies.schema, src), lambda s: logs, root, ckpt, {"availableNow": True}))
    want = IN.build_incidents(IN.dedup_anomalies(anomalies))
    n = F.coalesce("context.related_logs_count", F.lit(0)).alias("n")
    cols = ["incident_id", "severity", "title", "status"]
    full = sorted(map(tuple, IN.enrich(want, IN.context(IN.related_positions(want, logs))).select(*cols, n).collect()))
    stored = lambda: spark.read.parquet(f"{root}/incidents")
    assert sorted(map(tuple, stored().select(*cols, n).collect())) == full and full
    assert stored().select("batch").distinct().count() == 3
    keys = spark.read.parquet(f"{root}/keys")
    assert keys.count() == keys.select("dedup_key").distinct().count() == IN.dedup_anomalies(anomalies).count() > len(full)
    P.incident_pass(anomalies.where("anomaly_id BETWEEN 100 AND 220"), 1, lambda s: logs, root)       # replays
    P.incident_pass(anomalies.where("anomaly_id < 300"), 2, lambda s: logs, root)
    assert sorted(map(tuple, stored().select(*cols, n).collect())) == full
    no_time = spark.createDataFrame([(1,), (2,)], "anomaly_id long").select(
        *[F.col("anomaly_id") if f.name == "anomaly_id" else F.lit(True).alias(f.name) if f.name == "is_anomaly" else F.lit(None).cast(f.dataType).alias(f.name)
          for f in anomalies.schema.fields])
    for batch_id in (7, 8):                     # a key without time is processed once too
        P.incident_pass(no_time, batch_id, lambda s: logs, root)
    assert spark.read.parquet(f"{root}/keys").where("dt IS NULL").count() == 1


def test_alert_stream_equals_batch(spark, sf_small, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "c"))
    gaps = {"gap": 40_000, "critical_gap": 9_000}
    anomalies = TB.anomalies(spark, sf_small).where("timestamp < '2024-01-12'").persist()
    last = anomalies.agg(F.max("timestamp")).first()[0]
    # out of order by a day at most: batches by a shuffled half day, then a row far ahead to pass the rest
    at = (F.unix_seconds(F.col("timestamp").cast("timestamp")) / 43_200).cast("long")
    halves = [r[0] for r in anomalies.select(at.alias("h")).distinct().orderBy("h").collect()]
    swapped = [h for i in range(0, len(halves), 2) for h in reversed(halves[i:i + 2])]
    parts(anomalies.withColumn("h", at), src, [f"h = {h} AND anomaly_id % 2 = 0 OR h = {h} AND anomaly_id % 3 = 0" for h in swapped[:4]] + [F.col("h").isin(swapped)])
    ahead = anomalies.limit(1).withColumn("timestamp", F.lit("2024-02-20").cast("timestamp_ntz")).withColumn("is_anomaly", F.lit(True)).withColumn("h", F.lit(0).cast("long"))
    for i in (1, 2):
        ahead.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(F.lit(i))).withColumn("detector_type", F.lit("other")) \
            .withColumn("anomaly_id", F.lit(10**9 + i).cast("long")).coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    before = spark.conf.get(P.STATE_STORE[0], None)
    spark.conf.set(*P.STATE_STORE)
    try:
        sent = P.alert_stream(one_by_one(spark, schema, src), watermark="30 days", **gaps)
        available(sent.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
                  .trigger(availableNow=True).start(out))
    finally:
        spark.conf.unset(P.STATE_STORE[0]) if before is None else spark.conf.set(P.STATE_STORE[0], before)
    got = {r.anomaly_id for r in spark.read.parquet(out).collect() if r.anomaly_id < 10**9}
    horizon = F.lit("2024-02-22").cast("timestamp_ntz") - F.expr("INTERVAL 30 DAYS")
    assert last < spark.range(1).select(horizon.alias("t")).first().t
    want = {r.anomaly_id for r in AL.evaluate_alerts(anomalies, **gaps).where("sent").collect()}
    assert got == want and len(want) > 20


def test_alert_query_fills_the_outbox(spark, sf_small, tmp_path):
    src, root, ckpt = (str(tmp_path / x) for x in ("src", "out", "c"))
    gaps = {"gap": 40_000, "critical_gap": 9_000}
    anomalies = TB.anomalies(spark, sf_small).where("timestamp < '2024-01-08'").persist()
    want = AL.alert_outbox(AL.evaluate_alerts(anomalies, **gaps))
    rows = lambda df: sorted(map(repr, df.select(want.columns).collect()))
    stored = lambda: spark.read.parquet(f"{root}/alerts")
    full = rows(want)
    assert len(full) > 20 and want.select("channel").distinct().count() == 2
    parts(anomalies, src, ["anomaly_id % 2 = 0", "anomaly_id % 2 = 1"])
    ahead = anomalies.where("is_anomaly").limit(1).withColumn("detector_type", F.lit("other"))
    for i in (1, 2):            # pass the rest: the watermark is known a batch later
        ahead.withColumn("timestamp", F.lit(f"2024-03-0{i}").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(src)
    before = spark.conf.get(P.STATE_STORE[0], None)
    spark.conf.set(*P.STATE_STORE)
    try:
        available(P.alert_query(one_by_one(spark, anomalies.schema, src), lambda s: anomalies, root, ckpt, {"availableNow": True}, watermark="10 days", **gaps))
    finally:
        spark.conf.unset(P.STATE_STORE[0]) if before is None else spark.conf.set(P.STATE_STORE[0], before)
    assert rows(stored()) == full
    # replays, copies of records and batches without alerts change nothing
    batch = stored().first()["batch"]
    sent = AL.evaluate_alerts(anomalies, **gaps).where("sent").select("anomaly_id", "detector_type", F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("second"))
    of_batch = sent.join(stored().where(F.col("batch") == batch), ["anomaly_id", "detector_type"], "left_semi")
    P.alert_pass(of_batch.persist(), batch, lambda s: anomalies.unionByName(anomalies), root)
    P.alert_pass(sent.limit(0), batch + 100, lambda s: anomalies, root)
    assert rows(stored()) == full and stored().where(F.col("batch") == batch + 100).count() == 0


def test_outcomes_of_streamed_results(spark, tmp_path):
    req, res, ckpt = (str(tmp_path / x) for x in ("req", "res", "c"))
    t = lambda m: f"2024-01-01 00:{m:02d}:00"
    requests = [("a", t(0)), ("b", t(1)), ("c", t(2)), ("d", t(3)), ("z", "2024-01-02 00:00:00")]
    results = [("a", t(4), True, "x1", None), ("b", t(11), False, None, "HTTP 500"), ("c", t(13), True, "x3", None), ("q", t(3), True, "x4", None),
               ("z", "2024-01-02 00:00:00", True, "x5", None)]
    ntz = lambda df, c: df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    rq = ntz(spark.createDataFrame(requests, "incident_id string, requested_at string"), "requested_at")
    rs = ntz(spark.createDataFrame(results, "incident_id string, result_at string, accepted boolean, execution_id string, error string"), "result_at")
    want = sorted(map(repr, IN.workflow_results(rq, rs).where("incident_id <> 'z'").collect()))
    assert [r.outcome for r in IN.workflow_results(rq, rs).orderBy("incident_id").collect()] == ["accepted", "failed", "error", "error", "accepted"]
    parts(rq, req, ["incident_id IN ('b', 'c')", "incident_id IN ('a', 'd')", "incident_id = 'z'"])
    parts(rs, res, ["incident_id IN ('a', 'q')", "incident_id IN ('b', 'c')", "incident_id = 'z'"])
    out = P.outcome_stream(one_by_one(spark, rq.schema, req), one_by_one(spark, rs.schema, res), watermark="30 minutes")
    available(out.writeStream.format("memory").queryName("outcomes").outputMode("append").option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    assert sorted(map(repr, spark.sql("SELECT * FROM outcomes WHERE incident_id <> 'z'").collect())) == want


@pytest.mark.parametrize("width,slide", [("5 minutes", "30 seconds"), ("1 hour", "1 hour")])
def test_panes_add_up_to_sliding_windows(spark, sf_small, width, slide):
    logs = TB.logs(spark, sf_small).where("event_id < 400")
    want = FT.window_features(logs, width, None if width == slide else slide).withColumnRenamed("bucket", "window_start")
    got = FT.from_panes(FT.pane_counts(logs, slide), width, slide)
    rows = lambda df: sorted(map(tuple, df.select("window_start", "feature", "n").collect()))
    assert rows(got) == rows(want)


def test_late_rows_correct_their_windows(spark, sf_small, tmp_path):
    src, root, ckpt = (str(tmp_path / x) for x in ("src", "out", "c"))
    logs = TB.logs(spark, sf_small).where("event_id < 400").persist()
    parts(logs, src, ["event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2"])       # every batch is late for the ones before
    available(P.window_query(one_by_one(spark, logs.schema, src), root, ckpt, trigger={"availableNow": True}))
    want = sorted(map(tuple, FT.from_panes(FT.pane_counts(logs, ts="collected_at")).select("window_start", "feature", "n").collect()))
    rows = lambda: sorted(map(tuple, P.latest_windows(spark, root).select("window_start", "feature", "n").collect()))
    assert rows() == want and want
    third = spark.read.parquet(f"{root}/windows").where("batch = 2")
    assert third.select("window_start").distinct().count() < len({w for w, *_ in want})        # only what it touched
    P.window_pass(logs.where("event_id % 3 = 2"), 2, root, "5 minutes", "30 seconds", "collected_at")   # replay
    P.window_pass(logs.where("event_id < 0"), 3, root, "5 minutes", "30 seconds", "collected_at")       # nothing new
    assert rows() == want
