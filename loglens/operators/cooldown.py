"""Alert cooldown: per key (detector), an alert is sent when it is not low and
at least ``gap`` seconds passed since the last *sent* alert of that key
(``critical_gap`` for critical alerts, ``gap`` otherwise).  Low alerts never
send and do not touch the timer.  Events are taken in time order.

This greedy fold is order-dependent, so it is not a window function.  To keep
a hot key from landing in one task, it runs in three distributed phases over
time chunks of each key, over at most two rows a second (the first alert of
each class; a partial aggregate makes them before anything is gathered):

1. per (key, chunk), in pandas: for every non-low event ``i`` the pointer
   ``nxt(i)`` = the first later event that would be sent if ``i`` was the last
   one sent (two ``searchsorted`` calls), and ``exit(i)`` = the last event of
   the chunk on the chain starting at ``i``.  Only the *head* of the chunk
   (events before ``chunk_start + max_gap``, plus the first event after it,
   which is always eligible) can be the chain's first event; the chunk emits
   (time, class, exit time) for those head events only.
2. per key, fold the small chunk summaries in time order, carrying the last
   sent time: each chunk's first sent event is the first eligible head event.
   Its size is (#chunks × head events), at most two a second of the first
   ``max_gap`` of each chunk: bounded by the time span.
3. per (key, chunk), mark the chain from that first event as sent.

Exact for any chunk width; the width only has to exceed ``max_gap``.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import COOLDOWN_SECONDS, CRITICAL_COOLDOWN_SECONDS
from ..functions.parse import epoch_seconds


def _chains(t: np.ndarray, crit: np.ndarray, gap: float, critical_gap: float):
    """nxt index (or -1) for events sorted by time, all non-low."""
    n = len(t)
    idx = np.arange(n)
    ci, ni = idx[crit], idx[~crit]
    ct, nt = t[crit], t[~crit]
    # first critical at/after t + critical_gap, first non-critical at/after t + gap
    pc = np.searchsorted(ct, t + critical_gap, side="left")
    pn = np.searchsorted(nt, t + gap, side="left")
    cand_c = np.where(pc < len(ci), ci[np.minimum(pc, max(len(ci) - 1, 0))] if len(ci) else n, n)
    cand_n = np.where(pn < len(ni), ni[np.minimum(pn, max(len(ni) - 1, 0))] if len(ni) else n, n)
    nxt = np.minimum(cand_c, cand_n)
    return np.where(nxt >= n, -1, nxt)


def _exits(nxt: np.ndarray) -> np.ndarray:
    n = len(nxt)
    ex = np.arange(n)
    for i in range(n - 1, -1, -1):
        j = nxt[i]
        if j >= 0:
            ex[i] = ex[j]
    return ex


SUMMARY_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("chunk", T.LongType()),
    T.StructField("t", T.DoubleType()), T.StructField("crit", T.BooleanType()),
    T.StructField("exit_t", T.DoubleType()), T.StructField("pos", T.LongType()),
])

ENTRY_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("chunk", T.LongType()),
    T.StructField("entry_pos", T.LongType()),
])


def cooldown(events: DataFrame, key: str = "detector_type", ts: str = "timestamp",
             sev: str = "severity", id_col: str = "anomaly_id",
             gap: float = COOLDOWN_SECONDS, critical_gap: float = CRITICAL_COOLDOWN_SECONDS,
             chunk_seconds: int = 86400) -> DataFrame:
    """events + boolean ``sent``."""
    max_gap = max(gap, critical_gap)
    if chunk_seconds <= max_gap:
        raise ValueError("chunk_seconds must exceed the largest gap")
    base = events.select(
        F.col(id_col).alias("_id"), F.col(key).cast("string").alias("key"),
        epoch_seconds(F.col(ts)).cast("double").alias("t"), (F.col(sev) == "critical").alias("crit"),
        (F.col(sev) != "low").alias("active"))
    base = base.withColumn("chunk", F.floor(F.col("t") / chunk_seconds).cast("bigint"))
    # Of the alerts of one second and class only the first can be sent: whether
    # one may be sent depends on time and class alone, and a sent one blocks its
    # second.  So every later step has two rows a second at most, however many
    # alerts there are.
    act = (base.where("active").groupBy("key", "chunk", "t", "crit").agg(F.min("_id").alias("_id"))
               .select("_id", "key", "chunk", "t", "crit"))

    def summarize(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "_id"], kind="mergesort").reset_index(drop=True)
        t = pdf["t"].to_numpy(dtype=float)
        crit = pdf["crit"].to_numpy(dtype=bool)
        nxt = _chains(t, crit, gap, critical_gap)
        ex = _exits(nxt)
        start = float(pdf["chunk"].iloc[0]) * chunk_seconds
        head = np.nonzero(t < start + max_gap)[0]
        after = np.nonzero(t >= start + max_gap)[0]
        if len(after):
            head = np.append(head, after[0])
        return pd.DataFrame({"key": pdf["key"].iloc[0], "chunk": pdf["chunk"].iloc[0],
                             "t": t[head], "crit": crit[head], "exit_t": t[ex[head]],
                             "pos": head.astype("int64")})

    summaries = act.groupBy("key", "chunk").applyInPandas(summarize, SUMMARY_SCHEMA)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["chunk", "pos"], kind="mergesort")
        last = None
        rows = []
        for chunk, g in pdf.groupby("chunk", sort=True):
            t = g["t"].to_numpy(dtype=float)
            crit = g["crit"].to_numpy(dtype=bool)
            if last is None:
                k = 0
            else:
                need = np.where(crit, critical_gap, gap)
                ok = np.nonzero(t - last >= need)[0]
                if len(ok) == 0:      # every event of the chunk is still cooling down
                    rows.append((g["key"].iloc[0], int(chunk), -1))
                    continue
                k = int(ok[0])
            rows.append((g["key"].iloc[0], int(chunk), int(g["pos"].iloc[k])))
            last = float(g["exit_t"].iloc[k])
        return pd.DataFrame(rows, columns=["key", "chunk", "entry_pos"])

    entries = summaries.groupBy("key").applyInPandas(fold, ENTRY_SCHEMA)

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "_id"], kind="mergesort").reset_index(drop=True)
        t = pdf["t"].to_numpy(dtype=float)
        crit = pdf["crit"].to_numpy(dtype=bool)
        nxt = _chains(t, crit, gap, critical_gap)
        sent = np.zeros(len(t), dtype=bool)
        i = int(pdf["entry_pos"].iloc[0])
        while i >= 0:
            sent[i] = True
            i = int(nxt[i])
        return pd.DataFrame({"_id": pdf["_id"], "sent": sent})

    with_entry = act.join(entries, ["key", "chunk"], "inner")
    marked = with_entry.groupBy("key", "chunk").applyInPandas(mark, "_id long, sent boolean")
    return (events.join(marked.withColumnRenamed("_id", id_col), id_col, "left")
                  .withColumn("sent", F.coalesce(F.col("sent"), F.lit(False))))


def cooldown_fold_expr(gap: float = COOLDOWN_SECONDS, critical_gap: float = CRITICAL_COOLDOWN_SECONDS):
    """Single-group variant as a SQL ``aggregate`` over ``array_sort(collect_list(struct(t, id, sev)))``;
    for small inputs and for checking the distributed version."""
    init = F.struct(F.lit(None).cast("double").alias("last"),
                    F.array().cast("array<bigint>").alias("ids"))

    def step(acc, e):
        need = F.when(e["sev"] == "critical", F.lit(float(critical_gap))).otherwise(F.lit(float(gap)))
        ok = (e["sev"] != "low") & (acc["last"].isNull() | (e["t"] - acc["last"] >= need))
        return F.struct(F.when(ok, e["t"]).otherwise(acc["last"]).alias("last"),
                        F.when(ok, F.array_append(acc["ids"], e["id"])).otherwise(acc["ids"]).alias("ids"))
    return init, step
