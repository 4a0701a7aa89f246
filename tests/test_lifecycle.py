import pytest
from pyspark.sql import functions as F

from loglens import models as M
from loglens.plans import lifecycle as LC
from loglens.sources import tables as TB

AS_OF, TRAIN = "2024-01-20 00:00:00", 20 * 1440
LATER, DETECT = "2024-01-31 00:00:00", 11 * 1440


def test_stored_detectors_score_new_logs(trained):
    logs, root = trained
    minutes = dict.fromkeys((LC.FOREST, LC.SEQUENCE, LC.MESSAGE), DETECT)
    first = LC.detect_all(logs, root, LATER, minutes).drop("cluster_stats").collect()
    again = LC.detect_all(logs, root, LATER, minutes).drop("cluster_stats").collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))
    ids = [r.anomaly_id for r in first]
    assert None not in ids and len(set(ids)) == len(ids)
    assert {r.detector_type for r in first} == {LC.FOREST, LC.SEQUENCE, LC.MESSAGE}
    forest = [r for r in first if r.detector_type == LC.FOREST]
    n_logs = LC.collected(logs, LATER, DETECT).count()
    assert sum(r.log_count for r in forest) == n_logs
    assert all(-1 <= r.anomaly_score <= 0 and r.timestamp is not None and r.time_window_minutes == 5 for r in forest)
    message = [r for r in first if r.detector_type == LC.MESSAGE]
    assert [r.total_logs for r in message] == [LC.collected(logs, LATER, DETECT).where(F.length("message") > 0).count()]


def test_training_scores_hold_the_contamination(spark, sf_small, tmp_path):
    root = str(tmp_path / "models")
    logs = TB.logs(spark, sf_small)
    LC.train_forest(logs, root, AS_OF, TRAIN)
    on_train = LC.detect_forest(logs, root, AS_OF, TRAIN).collect()
    assert 0 < sum(r.is_anomaly for r in on_train) <= 0.05 * len(on_train) + 1
    assert LC.train_forest(logs, root, AS_OF, TRAIN) == 2 and M.latest_version(spark, root, LC.FOREST) == 2


def test_ranges_without_logs(trained, tmp_path):
    logs, root = trained
    assert LC.train_all(logs, str(tmp_path / "none"), "2020-01-01 00:00:00") == {LC.FOREST: None, LC.SEQUENCE: None, LC.MESSAGE: None}
    assert LC.detect_all(logs, root, "2020-01-01 00:00:00").count() == 0


def test_chosen_k_is_fitted(spark, tmp_path):
    root = str(tmp_path / "models")
    words = ["disk full", "disk slow", "login failed", "login ok", "cache miss", "cache hit"]
    rows = [(f"{w} on host{i}", "2024-01-01 00:00:00") for i in range(3) for w in words]
    logs = spark.createDataFrame(rows, "message string, at string").select("message", F.col("at").cast("timestamp_ntz").alias("collected_at"))
    LC.train_message(logs, root, "2024-01-01 00:00:00", 10, k=3, choose_k=True)
    meta, t = M.load_tables(spark, root, LC.MESSAGE, ["cluster_profile"])
    assert meta["k"] == 3 and 1 <= t["cluster_profile"].count() <= 3
    flagged = LC.flagged_messages(logs, root, "2024-01-01 00:00:00", 10)
    assert flagged.agg(F.sum("n")).first()[0] == len(rows)
    assert all(len(r.message) <= 4 for r in LC.message_samples(flagged, 5, 4).collect())


def test_training_when_missing_or_old(spark, sf_small, tmp_path):
    root = str(tmp_path / "models")
    logs = TB.logs(spark, sf_small).select("message", "collected_at")
    only = {LC.FOREST: None, LC.SEQUENCE: None, LC.MESSAGE: 1}        # the others lack columns
    assert LC.train_due(logs, root, AS_OF, TRAIN) == only
    assert LC.train_due(logs, root, "2024-01-20 23:59:59", TRAIN) == only
    assert LC.train_due(logs, root, "2024-01-21 00:00:00", TRAIN) == only | {LC.MESSAGE: 2}
    assert LC.train_due(logs, root, "2024-01-21 02:00:00", TRAIN, hours=2) == only | {LC.MESSAGE: 3}
    assert LC.train_due(logs, str(tmp_path / "none"), "2020-01-01 00:00:00") == dict.fromkeys(only)
    got = LC.cycle(logs, root, "2024-01-21 03:00:00", {LC.MESSAGE: DETECT})
    assert {r.detector_type for r in got.collect()} == {LC.MESSAGE} and M.latest_version(spark, root, LC.MESSAGE) == 3


def test_logs_without_a_column(trained):
    logs, root = trained
    assert LC.missing_columns(logs.drop("message", "source_file"), LC.SEQUENCE) == ["message", "source_file"]
    with pytest.raises(ValueError, match="component"):
        LC.detect_forest(logs.drop("component"), root, LATER, DETECT)
    assert LC.train_sequence(logs.drop("source_file"), root, AS_OF, TRAIN) is None
    minutes = dict.fromkeys((LC.FOREST, LC.SEQUENCE, LC.MESSAGE), DETECT)
    assert {r.detector_type for r in LC.detect_all(logs.drop("component"), root, LATER, minutes).select("detector_type").collect()} == {LC.MESSAGE}
