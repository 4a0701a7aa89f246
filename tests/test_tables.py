"""Stored tables: upsert by bucket, compaction by day, pruned scans."""
import os
from glob import glob

from pyspark.sql import functions as F

from loglens.plans import incidents as IN
from loglens.plans import lifecycle as LC
from loglens.sources import ingest as IG


def files(path):
    return {f: os.stat(f).st_ino for f in glob(f"{path}/**/*.parquet", recursive=True)}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "incidents")
    frame = lambda rows: spark.createDataFrame(rows, "incident_id string, status string, updated_at long")
    first = [(f"i{n}", "new", 1) for n in range(40)]
    IN.upsert_table(path, frame(first), buckets=8)
    before = files(path)
    change = [("i3", "responded", 2), ("i3", "old", 0), ("i4", "late", 0), ("x", "new", 5)]
    for _ in range(2):      # a repeated call changes nothing
        IN.upsert_table(path, frame(change), buckets=8)
    want = {**{i: s for i, s, _ in first}, "i3": "responded", "x": "new"}
    got = spark.read.parquet(path)
    assert {r.incident_id: r.status for r in got.collect()} == want and got.count() == 41
    touched = {r[0] for r in frame(change).select(F.pmod(F.xxhash64("incident_id"), F.lit(8))).distinct().collect()}
    untouched = {f: i for f, i in before.items() if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert untouched and untouched.items() <= files(path).items()
    IN.upsert_table(path, frame([]), buckets=8)
    assert got.count() == 41


def lines(spark, n, at):
    rows = spark.createDataFrame([(f"2024-01-0{1 + n % 3} 00:00:{n:02d} INFO web ok {n}", "a.log")], "value string, source_file string")
    return IG.parse_log_frame(rows, F.lit(at))


def test_compaction_by_day(spark, tmp_path):
    path, bad, closed = (str(tmp_path / x) for x in ("logs", "bad", "closed"))
    assert IG.compact_days(spark, path, closed, "2024-01-03") == 0 and IG.log_table(spark, path, closed) is None
    texts = lambda: sorted(r.message for r in IG.log_table(spark, path, closed).collect())
    for n in range(6):
        IG.write_log_tables(lines(spark, n, f"2024-01-0{1 + n // 2} 00:01:00"), path, bad, n)
    want = [f"ok {n}" for n in range(6)]
    assert texts() == want
    assert IG.compact_days(spark, path, closed, "2024-01-03") == 2
    assert texts() == want and len(glob(f"{path}/dt=*/batch=*/*.parquet")) == 2 and len(glob(f"{closed}/dt=*")) == 2
    IG.write_log_tables(lines(spark, 6, "2024-01-01 00:02:00"), path, bad, 6)           # a closed day again
    IG.write_log_tables(lines(spark, 1, "2024-01-01 00:01:00"), path, bad, 1)           # a copy that wasn't deleted
    assert texts() == [*want, "ok 6"]
    assert IG.compact_days(spark, path, closed, "2024-01-03") == 1 and texts() == [*want, "ok 6"]


def test_detector_scans_read_their_days(spark, tmp_path, capsys):
    path = str(tmp_path / "logs")
    for n in range(3):
        IG.write_batch(lines(spark, n, f"2024-01-0{1 + n} 00:01:00"), path, n)
    got = LC.collected(spark.read.parquet(path), "2024-01-02 12:00:00", 600)
    assert got.count() == 0 and LC.collected(spark.read.parquet(path), "2024-01-02 12:00:00", 1440).count() == 1
    got.explain()
    plan = capsys.readouterr().out
    assert "dt" in plan.split("PartitionFilters: [")[1].split("]")[0]
    none = LC.collected(spark.read.parquet(path).drop("dt"), "2024-01-02 12:00:00", 1440)
    assert none.count() == 1
