import datetime as dt

from pyspark.sql import functions as F

from loglens.operators import interval_join as IJ
from loglens.operators.interval_join import first_in_interval, interval_join


def test_bounds_and_brute_force(spark):
    base = "2024-01-01 12:00:00"
    probes = spark.createDataFrame([(1, base), (2, "2024-01-01 13:07:00"), (3, None)], "pid int, ts string") \
                  .select("pid", F.col("ts").cast("timestamp_ntz").alias("ts"))
    offs = [-1801, -1800, -1, 0, 299, 300, 301, 3000, 4020, 4320, 4321, 4621]
    ev = spark.createDataFrame([(i, o) for i, o in enumerate(offs)], "eid int, o int").select(
        "eid", (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                       F.col("o").cast("decimal(18,6)"))).alias("ets"))
    got = {(r.pid, r.eid) for r in interval_join(probes, ev, "ts", "ets", 1800, 300).collect()}
    brute = {(r.pid, r.eid) for r in probes.crossJoin(ev).where(
        (F.col("ets") >= F.col("ts") - F.expr("INTERVAL 30 MINUTES")) &
        (F.col("ets") <= F.col("ts") + F.expr("INTERVAL 5 MINUTES"))).collect()}
    assert got == brute
    assert (1, offs.index(-1800)) in got and (1, offs.index(300)) in got
    assert (1, offs.index(-1801)) not in got and (1, offs.index(301)) not in got


def test_one_dense_second_is_cut_before_it_is_ordered(spark, capsys):
    base = "2024-01-01 12:00:00"
    probes = spark.createDataFrame([(1, base), (2, "2024-01-01 12:00:40")], "pid int, ts string").select("pid", F.col("ts").cast("timestamp_ntz").alias("ts"))
    offs = {i: -60 if i % 100 == 0 else 10 if i % 3 else i % 50 for i in range(900)}
    ev = spark.createDataFrame(list(offs.items()), "eid int, o int").select(
        "eid", (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o").cast("decimal(18,6)"))).alias("ets"))
    out = first_in_interval(probes, ev, "ts", "ets", ["eid"], 35, 30, 20)
    for pid, at in ((1, 0), (2, 40)):
        near = sorted((o, i) for i, o in offs.items() if at - 35 <= o <= at + 30)
        assert sorted((r["rank"], r["eid"], r["total"]) for r in out.collect() if r["pid"] == pid) == [(k + 1, i, len(near)) for k, (_, i) in enumerate(near[:20])]
    out.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_counts_of_first_events_against_brute_force(spark, monkeypatch):
    import random
    from collections import Counter

    monkeypatch.setattr(IJ, "CUBE_BLOCK", 4)
    monkeypatch.setattr(IJ, "CUBE_SPAN", 3)
    rng = random.Random(6)
    at = lambda c: F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(c).cast("decimal(18,6)"))
    ev = [(i, 500 if i % 3 == 0 else rng.randrange(2000), rng.choice(["a", "b", None, f"v{i}"]), rng.choice("xyz")) for i in range(400)]
    pr = [(i, rng.randrange(-50, 2100)) for i in range(120)] + [(200, None)]
    events = spark.createDataFrame(ev, "eid int, o int, level string, comp string").withColumn("ets", at("o"))
    probes = spark.createDataFrame(pr, "pid int, o int").select("pid", "o", at("o").alias("ts"))
    for n in (1, 13, 60):
        where = IJ.positions(probes, events, "ts", "ets", ["eid"], 90, 20, n)
        got = IJ.first_counts(where, {"level": F.col("level"), "comp": F.upper("comp")})
        per = {}
        for r in got.join(where.probes, "_ps").collect():
            per.setdefault(r.pid, {})[(r.kind, r.value)] = r.n
        want = {}
        for pid, o in pr:
            near = sorted((t, i, lv, c) for i, t, lv, c in ev if o is not None and o - 90 <= t <= o + 20)[:n] if o is not None else []
            if near:
                want[pid] = dict(Counter([("level", x[2]) for x in near] + [("comp", x[3].upper()) for x in near]))
        assert per == want
        totals = {r.pid: (r["_end"] - r["_start"], r["_total"]) for r in where.ranges.join(where.probes, "_ps").collect()}
        full = {p: sum(o - 90 <= t <= o + 20 for _, t, *_ in ev) for p, o in pr if o is not None}
        assert {p: t[1] for p, t in totals.items()} == {p: c for p, c in full.items() if c}
        assert all(min(t[0], n) == min(t[1], n) for t in totals.values())


def test_context_is_counted_by_chunks_without_a_cube(spark):
    ev = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i // 3), f"c{i % 150}", None if i % 7 else "x") for i in range(9000)],
                               "id long, t timestamp_ntz, comp string, msg string")
    pr = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=11 * i)) for i in range(290)], "p long, at timestamp_ntz")
    where = IJ.positions(pr, ev, "at", "t", ["id"], 600, 60, 1000)
    out = IJ.first_summary(where, {"comp": F.col("comp")}, {"id": F.col("id"), "msg": F.col("msg")}, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "sequence(" not in plan
    got = {r._ps: r for r in out.collect()}
    first = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    want = 0
    for i in range(290):
        ids = [j for j in range(max(0, 11 * i - 600) * 3, min(3000, 11 * i + 61) * 3) if j < 9000]
        if not ids:
            continue
        want += 1
        r, head = got[first + 11 * i], ids[:1000]
        counts = {}
        for j in head:
            counts[f"c{j % 150}"] = counts.get(f"c{j % 150}", 0) + 1
        assert (r._total, r._count, r.comp) == (len(ids), len(head), counts)
        assert [(x.id, x.msg) for x in r._rows] == [(j, None if j % 7 else "x") for j in head[:3]]
    assert len(got) == want


def test_rows_of_a_probe_lie_together_and_a_hot_second_is_shared(spark, monkeypatch, tmp_path):
    for name, value in (("SHARE", 40), ("TASK_ROWS", 500), ("TASK_PROBES", 100)):
        monkeypatch.setattr(IJ, name, value, raising=False)
    start = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(i, start + dt.timedelta(seconds=i * 7 % 901)) for i in range(2000)], "eid long, ets timestamp_ntz").repartition(7)
    seconds = [450] * 300 + [13 * i for i in range(80)]
    pr = spark.createDataFrame([(i, {"k": i}, start + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)], "pid long, m map<string,long>, ts timestamp_ntz")
    order = sorted((i * 7 % 901, i) for i in range(2000))
    for n, k in ((30, 30), (30, 11), (5000, 5000)):
        at = IJ.positions(pr, ev, "ts", "ets", ["eid"], 60, 20, n)
        out = IJ.first_rows(at, k)
        assert out.columns == ["pid", "m", "ts", "total", "eid", "ets", "rank"]
        parts = out.select("pid", "eid", "rank", "total").rdd.glom().collect()
        rows = [r for part in parts for r in part]
        want = []
        for pid, s in enumerate(seconds):
            near = [e for t, e in order if s - 60 <= t <= s + 20]
            want += [(pid, e, r + 1, len(near)) for r, e in enumerate(near[:k])]
        assert sorted(map(tuple, rows)) == sorted(want)
        # whole and oldest first
        assert all((a.pid, a.rank + 1) == (b.pid, b.rank) or b.rank == 1 for part in parts for a, b in zip([None] + part, part) if a is not None)
        assert sum(r.rank == 1 for r in rows) == len({r.pid for r in rows})
        assert sum(any(r.pid < 300 for r in part) for part in parts) > 1
