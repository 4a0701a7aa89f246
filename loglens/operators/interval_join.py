"""Interval (range) join: probe rows × event rows with
``event_ts ∈ [probe_ts - before, probe_ts + after]`` (both ends inclusive).

Spark has no range-join strategy; a plain non-equi predicate becomes a
nested-loop join.  Here both sides get an equi-join key on time buckets of
width ``bucket_seconds`` (≥ before + after by default): each event falls in
one bucket, each probe explodes to the few buckets its interval touches, and
the exact bounds are re-checked after the equi-join.  The join is then a
sort-merge/hash join on ``bucket`` whose exchanges are Spark's own, so AQE can
split a skewed bucket; every output pair is produced exactly once.

Where only the oldest ``n`` events of each interval are wanted, or counts over
them, :func:`positions` numbers the events once; :func:`first_rows` then looks
rows up by block of positions (never more than ``n`` rows a probe, however dense the
events are) and :func:`first_summary` counts values without building rows.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.parse import epoch_seconds
from ..session import ship_package


def interval_join(probes: DataFrame, events: DataFrame, probe_ts: str, event_ts: str,
                  before_seconds: int, after_seconds: int, bucket_seconds: int | None = None,
                  how: str = "inner") -> DataFrame:
    b = bucket_seconds or max(before_seconds + after_seconds, 1)
    pt = epoch_seconds(F.col(probe_ts))
    p = (probes.withColumn("_pt", pt)
               .withColumn("_b", F.explode(F.sequence(F.floor((F.col("_pt") - before_seconds) / b),
                                                      F.floor((F.col("_pt") + after_seconds) / b)))))
    e = (events.withColumn("_et", epoch_seconds(F.col(event_ts)))
               .withColumn("_b", F.floor(F.col("_et") / b)))
    cond = [p["_b"] == e["_b"],
            e["_et"] >= p["_pt"] - before_seconds,
            e["_et"] <= p["_pt"] + after_seconds]
    j = p.join(e, cond, how)
    return j.drop(p["_b"]).drop(e["_b"]).drop("_pt", "_et")


def _day(sec: str):
    return F.floor(F.col(sec) / 86400)


def _running(per_second: DataFrame) -> DataFrame:
    """(sec, n, kept) → (sec, n, kept, upto, kept_upto): events, and numbered
    events, up to and including each second.  Days are summed first, then seconds
    within a day: a window never holds more than the days, or the seconds of one
    day."""
    days = per_second.groupBy(_day("sec").alias("day")).agg(F.sum("n").alias("dn"), F.sum("kept").alias("dk"))
    by_day, in_day = Window.orderBy("day"), Window.partitionBy("day").orderBy("sec")
    first = days.select("day", (F.sum("dn").over(by_day) - F.col("dn")).alias("first"), (F.sum("dk").over(by_day) - F.col("dk")).alias("first_kept"))
    return (per_second.withColumn("day", _day("sec")).join(first, "day")
            .select("sec", "n", "kept", (F.col("first") + F.sum("n").over(in_day)).alias("upto"),
                    (F.col("first_kept") + F.sum("kept").over(in_day)).alias("kept_upto")))


@dataclass
class Positions:
    """Intervals as ranges of event positions.

    ``ranges``  (_ps, _start, _end, _total): numbered events [_start, _end) of the
                interval around second ``_ps``, and all of its events;
    ``placed``  the numbered events with ``_pos``, the first ``n`` of each second;
    ``probes``  the probes with ``_ps``."""
    probes: DataFrame
    ranges: DataFrame
    placed: DataFrame
    n: int


def positions(probes: DataFrame, events: DataFrame, probe_ts: str, event_ts: str, order: list[str],
              before_seconds: int, after_seconds: int, n: int, keep=lambda df: df, cut=lambda df: df) -> Positions:
    """Number the events by time (whole seconds), then ``order``, and find the
    range of positions of each probe's interval [ts - before, ts + after].

    An interval starts with a second, so place n or later of a second is never
    among an interval's first n: only the first n events of a second are numbered,
    and each task cuts its rows of a second before one task orders what is left.
    ``keep`` is applied to the numbered events, e.g. to persist them; ``cut`` to the
    tables of seconds, e.g. to checkpoint them, which also keeps plans short."""
    ev = events.withColumn("_sec", epoch_seconds(F.col(event_ts)))
    pr = probes.withColumn("_ps", epoch_seconds(F.col(probe_ts))).where(F.col("_ps").isNotNull())
    per_second = ev.where(F.col("_sec").isNotNull()).groupBy(F.col("_sec").alias("sec")).agg(F.count(F.lit(1)).alias("n"))
    at = pr.select("_ps").distinct().select("_ps", (F.col("_ps") - before_seconds - 1).alias("lo"), (F.col("_ps") + after_seconds).alias("hi"))
    points = at.select(F.explode(F.array("lo", "hi")).alias("sec")).distinct().withColumn("n", F.lit(0).cast("long"))
    line = cut(_running(per_second.unionByName(points).groupBy("sec").agg(F.sum("n").alias("n")).withColumn("kept", F.least("n", F.lit(n).cast("long")))))
    low = line.select(F.col("sec").alias("lo"), F.col("upto").alias("_before"), F.col("kept_upto").alias("_start"))
    high = line.select(F.col("sec").alias("hi"), F.col("upto"), F.col("kept_upto").alias("_end"))
    ranges = cut(at.join(low, "lo").join(high, "hi").where(F.col("_end") > F.col("_start"))
                 .select("_ps", "_start", "_end", (F.col("upto") - F.col("_before")).alias("_total")))
    first = line.where(F.col("n") > 0).select(F.col("sec").alias("_sec"), (F.col("kept_upto") - F.col("kept")).alias("_first"))
    own = ev.withColumn("_own", F.row_number().over(Window.partitionBy("_sec").orderBy(*order))).where(F.col("_own") <= n)
    placed = own.join(first, "_sec").withColumn("_pos", F.col("_first") + F.col("_own") - 1).drop("_first", "_sec", "_own")
    return Positions(pr, ranges, keep(placed), n)


#: Probes of a block that one copy of its events serves, and about as many rows and
#: probes as one task of a lookup gets.
SHARE, TASK_ROWS, TASK_PROBES = 8192, 2**23, 2**13


def first_rows(at: Positions, k: int, probes: DataFrame | None = None, rank_col: str = "rank", total_col: str = "total") -> DataFrame:
    """The oldest ``k`` events (at most ``at.n``) of each probe's interval, with
    their rank and the number of all events of the interval.  ``probes`` (with
    ``_ps``) restricts the lookup to some of them.

    A range is cut to k and looked up in the block of k positions it starts in; an
    event goes to its own block and the one before.  So a probe's rows are made
    together and oldest first, next to those of probes with nearly the same events:
    stored, most columns are runs and repeats.  Blocks with many probes are dealt in
    shares, and the number of tasks follows the rows to be made."""
    if k > at.n:
        raise ValueError("more rows asked for than are numbered")
    probes = at.probes if probes is None else probes
    size = F.least(F.col("_end") - F.col("_start"), F.lit(k))
    block = F.floor(F.col("_start") / k)
    per_block = (probes.groupBy("_ps").agg(F.count(F.lit(1)).alias("m")).join(at.ranges, "_ps")
                 .groupBy(block.alias("_b")).agg(F.sum("m").alias("m"), F.sum(F.col("m") * size).alias("rows")))
    rows, m = per_block.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
    tasks = int(max(at.placed.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS, m // TASK_PROBES))
    # few: each stands for more than SHARE probes
    many = F.broadcast(per_block.where(F.col("m") > SHARE).select("_b", F.ceil(F.col("m") / SHARE).cast("int").alias("_shares")))
    shares = F.coalesce("_shares", F.lit(1))
    marks = [c for c, t in probes.dtypes if "map<" not in t and "variant" not in t]
    p = (probes.withColumn("_share", F.xxhash64(*marks)).join(at.ranges, "_ps").withColumn("_b", block).join(many, "_b", "left")
         .withColumn("_pb", F.col("_b")).withColumn("_pshare", F.pmod("_share", shares).cast("int"))
         .withColumn("_lo", F.col("_start") - F.col("_b") * k).withColumn("_hi", F.col("_lo") + size)
         .drop("_b", "_share", "_shares", "_ps", "_start", "_end"))
    own = F.floor(F.col("_pos") / k)
    e = (at.placed.withColumn("_b", F.explode(F.array(own, own - 1))).join(many, "_b", "left")
         .withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares"))
    p, e = p.repartition(tasks, "_pb", "_pshare"), e.repartition(tasks, "_b", "_share")
    # numbered, the probes of a share stay in this order: Parquet packs repeated values by
    # eights, so intervals that differ by whole eights of events repeat each other's bytes
    p = p.withColumn("_nth", F.row_number().over(Window.partitionBy("_pb", "_pshare").orderBy(F.col("_lo") % 8, "_lo"))).where(F.col("_nth") > 0).drop("_nth")
    # positions have no gaps: the number within a block is the distance from its start
    e = e.withColumn("_at", F.row_number().over(Window.partitionBy("_b", "_share").orderBy("_pos")) - 1).drop("_pos")
    j = p.join(e.hint("merge"), (F.col("_pb") == F.col("_b")) & (F.col("_pshare") == F.col("_share")) & (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))
    return (j.withColumn(rank_col, (F.col("_at") - F.col("_lo") + 1).cast("int"))
            .withColumnRenamed("_total", total_col)
            .drop("_pb", "_b", "_pshare", "_share", "_at", "_lo", "_hi"))


#: Values counted at a time, by which factor a chunk has more positions, and ranges
#: counted at a time.
CUBE_BLOCK, CUBE_SPAN, RANGES = 64, 64, 8192


def _counts(values, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """Per range [lo, hi) of the values: a map from value to count, in order of value.
    Running counts of CUBE_BLOCK values at a time, so memory doesn't grow with the vocabulary."""
    coded = pc.dictionary_encode(values, null_encoding="encode")
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    order = sorted(range(len(coded.dictionary)), key=lambda i: coded.dictionary[i].as_py())
    place = np.empty(len(order), dtype="int64")
    place[order] = np.arange(len(order))
    codes = place[coded.indices.to_numpy(zero_copy_only=False)]
    found = []
    for v in range(0, len(order), CUBE_BLOCK):
        upto = np.zeros((len(codes) + 1, min(CUBE_BLOCK, len(order) - v)), dtype="int32")
        upto[1:] = np.cumsum(codes[:, None] == np.arange(v, v + upto.shape[1])[None, :], axis=0)
        for r in range(0, len(lo), RANGES):
            n = upto[hi[r:r + RANGES]] - upto[lo[r:r + RANGES]]
            at, which = np.nonzero(n)
            found.append((at + r, which + v, n[at, which]))
    row, value, n = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((value, row))
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lo)))])
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), coded.dictionary.take(pa.array(np.array(order)[value[by]])), pa.array(n[by], pa.int64()))


def _first(rows: pa.Table, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """Per range [lo, hi) its rows, as a list of structs."""
    size = hi - lo
    ends = np.concatenate([[0], np.cumsum(size)])
    picked = rows.take(pa.array(np.arange(ends[-1]) - np.repeat(ends[:-1] - lo, size)))
    fields = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in picked.columns]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, rows.column_names))


def first_summary(at: Positions, values: dict[str, Column], shown: dict[str, Column], k: int, n: int | None = None,
                  sums: dict[str, Column] | None = None, span: Column | None = None, only: Column | None = None,
                  seconds: DataFrame | None = None) -> DataFrame:
    """(_ps, _total, _count, one map<value, n> per kind, _rows) of each interval: the
    events of the interval, those among the first ``n`` (``at.n`` if not given), how often
    each value occurs among them (``values`` maps a kind to a column of the events, cast
    to string and not null), and the columns ``shown`` of the first ``k``, or of the
    first ``k`` among them that hold the condition ``only``.  ``sums`` adds the number
    of them that hold each condition, ``span`` the least and the greatest of a
    timestamp_ntz that is never null (_least, _greatest); ``seconds`` (_ps) restricts
    the intervals.

    The positions are cut into chunks; a chunk's task gets its events, those
    that follow within ``n`` positions, and the ranges that start in it.  Each event
    goes to two chunks at most and each range to one, so the shuffle grows with the
    input.  Ranges of a chunk are at most its seconds times the interval's."""
    n = at.n if n is None else n
    if n > at.n:
        raise ValueError("more events asked for than are numbered")
    width = max(CUBE_BLOCK * CUBE_SPAN, n)
    chunk = F.floor(F.col("_pos") / width)
    near = F.when((F.col("_pos") % width < n) & (F.col("_pos") >= width), F.array(chunk, chunk - 1)).otherwise(F.array(chunk))
    kinds, cols, flags, spans = list(values), list(shown), list(sums or {}), ["_least", "_greatest"] if span is not None else []
    holds = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    e = at.placed.select(F.col("_pos").cast("long").alias("_pos"), F.explode(near).alias("_c"), holds.alias("_holds"),
                         *[span.cast("timestamp_ntz").alias("_at") for _ in spans[:1]],
                         *[F.coalesce(c, F.lit(False)).alias(f"_f{i}") for i, c in enumerate((sums or {}).values())],
                         *[v.cast("string").alias(f"_v{i}") for i, v in enumerate(values.values())],
                         *[F.when(holds, v).alias(f"_s{i}") for i, v in enumerate(shown.values())])
    stop = F.least(F.col("_end"), F.col("_start") + n)
    ranges = at.ranges if seconds is None else at.ranges.join(seconds.select("_ps").distinct(), "_ps", "left_semi")
    r = ranges.select(F.floor(F.col("_start") / width).alias("_c"), "_ps", "_total", F.col("_start").cast("long").alias("_start"), stop.cast("long").alias("_stop"))

    def chunked(events, ranges):
        events = events.sort_by("_pos")
        pos = events["_pos"].to_numpy()
        start, stop = ranges["_start"].to_numpy(), ranges["_stop"].to_numpy()
        lo, hi = np.searchsorted(pos, start), np.searchsorted(pos, stop)
        held = np.concatenate([[0], np.cumsum(events["_holds"].to_numpy())])
        rows = pa.table({c: events[f"_s{i}"] for i, c in enumerate(cols)}).filter(events["_holds"])
        counted = []
        for i in range(len(flags)):
            upto = np.concatenate([[0], np.cumsum(events[f"_f{i}"].to_numpy())])
            counted.append(pa.array(upto[hi] - upto[lo], pa.int64()))
        if spans:
            # a range isn't empty; the last entry only closes it
            times = np.append(events["_at"].cast("int64").to_numpy(), 0)
            bounds = np.column_stack([lo, hi]).ravel()
            counted += [pa.array(f.reduceat(times, bounds)[::2]).cast(pa.timestamp("us")) for f in (np.minimum, np.maximum)]
        return pa.table([ranges["_ps"].cast("int64"), ranges["_total"].cast("int64"), pa.array(stop - start),
                         *[_counts(events[f"_v{i}"], lo, hi) for i in range(len(kinds))], *counted,
                         _first(rows, held[lo], np.minimum(held[hi], held[lo] + k))],
                        names=["_ps", "_total", "_count", *kinds, *flags, *spans, "_rows"])

    types = dict(e.dtypes)
    made = ", ".join(f"`{c}`: {types[f'_s{i}']}" for i, c in enumerate(cols))
    schema = ("_ps long, _total long, _count long, " + "".join(f"`{x}` map<string, bigint>, " for x in kinds) + "".join(f"`{x}` long, " for x in flags)
              + "".join(f"{x} timestamp_ntz, " for x in spans) + f"_rows array<struct<{made}>>")

    none = to_arrow_schema(T._parse_datatype_string(schema)).empty_table()

    def summary(events, ranges):
        if len(ranges) and len(events):
            return chunked(events, ranges)
        return none

    ship_package(at.placed.sparkSession)
    return e.groupBy("_c").cogroup(r.groupBy("_c")).applyInArrow(summary, schema)


def first_counts(at: Positions, values: dict[str, Column]) -> DataFrame:
    """(_ps, kind, value, n): how often each value occurs among the first ``at.n``
    events of each interval; ``values`` maps a kind to a column of the events."""
    # a leading mark keeps nulls, which a map can't have as keys, apart from every text
    marked = {k: F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("")) for k, v in values.items()}
    s = first_summary(at, marked, {"_pos": F.col("_pos")}, 0)
    parts = [s.select("_ps", F.lit(k).alias("kind"), F.explode(k).alias("value", "n")) for k in values]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("value", F.when(F.col("value") != "", F.substring("value", 2, 2**31 - 1)))


def first_in_interval(probes: DataFrame, events: DataFrame, probe_ts: str, event_ts: str, order: list[str],
                      before_seconds: int, after_seconds: int, n: int,
                      rank_col: str = "rank", total_col: str = "total") -> DataFrame:
    """The oldest ``n`` events of each probe's interval (see :func:`positions` and
    :func:`first_rows`).  Probes without events have no rows."""
    at = positions(probes, events, probe_ts, event_ts, order, before_seconds, after_seconds, n)
    return first_rows(at, n, rank_col=rank_col, total_col=total_col)
