"""Sharding by minimax contiguous partition of atomic groups.

Rows with equal texts form an atomic group (keyed by the 64-bit hash of the
text) and never part.  In order of their key they are cut into contiguous runs:
a binary search finds the smallest capacity for which a greedy pass from the
left needs no more shards than there are, and the greedy pass at that capacity
gives the cuts.

A group larger than an even share of what the other shards must hold makes
that capacity so large that few shards take all the rest.  Such groups are then
given a shard each and the others are cut among the remaining shards, unless
that needs a larger capacity than the cut of the full order.

The search never sees all groups.  The driver holds sums over key ranges
(2**FIRST_BITS at the start).  At every capacity two greedy passes bound the
truth: one may cut only at known range borders, the other may also cut
anywhere inside a range of several groups.  Only ranges in which a cut can
still fall are split by STEP_BITS more key bits (one small aggregate each
round), until both passes agree on the smallest capacity, which is then exact.

Defined results: a null text is a group of its own with size 16 like the
empty one; null ids are kept; repeated rows are rows of their own; an empty
table gives an empty result; more shards than groups leave shards empty.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import pick, stored, table

FIRST_BITS = 14
STEP_BITS = 6
ROW_BYTES = 16
#: Rows numbered by one task at most, about (see ``slots``).
SLOT_ROWS = 20_000


def text_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, grp for each row; reads each text once."""
    t = F.col("text")
    utf8 = F.coalesce(t, F.lit("")).cast("binary")
    return pick(df, doc_id=id_col, text=text_col).select(
        "doc_id", (F.octet_length(F.coalesce(t, F.lit(""))) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"), F.xxhash64(t, t.isNull()).alias("grp"))


class Ranges:
    """Sums over disjoint key ranges in key order, some known to be one group."""

    def __init__(self, groups: DataFrame):
        """groups: key ``grp`` (unique), ``bytes``."""
        self.groups = groups
        self.rows = self._summed(groups, FIRST_BITS)

    @staticmethod
    def _summed(groups: DataFrame, bits: int) -> list[tuple]:
        """(first key, bits, bytes, groups) of the non-empty ranges: at most
        2**FIRST_BITS, or 2**STEP_BITS for each range that is split."""
        at = F.shiftright("grp", 64 - bits) if bits < 64 else F.col("grp")
        out = groups.groupBy(at.alias("b")).agg(F.sum("bytes").alias("s"), F.count(F.lit(1)).alias("n")).collect()
        return sorted((int(r["b"]) << (64 - bits), bits, int(r["s"]), int(r["n"])) for r in out)

    def split(self, which: list[int]) -> None:
        spark = self.groups.sparkSession
        new = []
        for bits in sorted({self.rows[i][1] for i in which}):
            at = F.shiftright("grp", 64 - bits) if bits < 64 else F.col("grp")
            keys = spark.createDataFrame([(self.rows[i][0] >> (64 - bits),) for i in which if self.rows[i][1] == bits], "b long")
            hit = self.groups.withColumn("b", at.cast("long")).join(F.broadcast(keys), "b", "left_semi").select("grp", "bytes")
            new += self._summed(hit, min(64, bits + STEP_BITS))
        gone = set(which)
        self.rows = sorted([r for i, r in enumerate(self.rows) if i not in gone] + new)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Borders in bytes, and which ranges hold several groups."""
        return (np.concatenate([[0], np.cumsum([r[2] for r in self.rows], dtype=np.int64)]).astype(np.int64),
                np.array([r[3] > 1 for r in self.rows], dtype=bool))


def greedy(borders: np.ndarray, open_: np.ndarray, k: int, cap: int, inside: bool) -> tuple[list[int], bool]:
    """Cuts (in bytes) of a greedy pass and whether k shards suffice."""
    pos, total, cuts = 0, int(borders[-1]), []
    for _ in range(k):
        if pos + cap >= total:
            return cuts, True
        i = int(np.searchsorted(borders, pos + cap, "right")) - 1
        pos = pos + cap if inside and open_[i] else max(pos, int(borders[i]))
        cuts.append(pos)
    return cuts, False


def smallest(borders: np.ndarray, open_: np.ndarray, k: int, inside: bool) -> int:
    lo, hi = -(-int(borders[-1]) // k), int(borders[-1])
    while lo < hi:
        mid = (lo + hi) // 2
        if greedy(borders, open_, k, mid, inside)[1]:
            hi = mid
        else:
            lo = mid + 1
    return lo


def minimax_cuts(groups: DataFrame, k: int) -> tuple[int, list[int]]:
    """(capacity, first key of each shard after the first) for groups
    (``grp`` unique, ``bytes``); exact."""
    if k < 1:
        raise ValueError("no shard is left for the smaller groups")
    ranges = Ranges(groups)
    if not ranges.rows:
        return 0, []
    while True:
        borders, open_ = ranges.arrays()
        low, high = smallest(borders, open_, k, True), smallest(borders, open_, k, False)
        cuts, _ = greedy(borders, open_, k, high, False)
        first = greedy(borders, open_, k, low, False)[0]
        last = greedy(borders, open_, k, high, True)[0] + [int(borders[-1])] * k
        split: set[int] = set()
        for a, b in zip(first, last):
            i, j = int(np.searchsorted(borders, a, "right")) - 1, int(np.searchsorted(borders, b, "left"))
            split.update(x for x in range(max(i, 0), min(j, len(open_))) if open_[x])
        if low == high or not split:
            return high, [ranges.rows[int(np.searchsorted(borders, c))][0] for c in cuts]
        ranges.split(sorted(split))


def plan(groups: DataFrame, k: int) -> tuple[list[int], list[int]]:
    """(keys of the groups with a shard each, cuts of the others); no shard holds
    more than the smallest capacity of the full order."""
    cap, cuts = minimax_cuts(groups, k)
    top = groups.orderBy(F.desc("bytes"), "grp").limit(k).collect()   # k rows
    rest = int(groups.agg(F.sum("bytes")).first()[0] or 0)
    alone = []
    for r in top[:k - 1]:
        if r["bytes"] * (k - len(alone)) <= rest:
            break
        alone.append(int(r["grp"]))
        rest -= int(r["bytes"])
    if alone:
        own_cap, own_cuts = minimax_cuts(groups.filter(~F.col("grp").isin(alone)), k - len(alone))
        if own_cap <= cap:      # a group is never larger than cap
            return alone, own_cuts
    return [], cuts


def shard_column(alone: list[int], cuts: list[int], grp: Column) -> Column:
    """Shard by key: the cut runs first, then the groups that stand alone."""
    run = F.lit(0)
    for c in cuts:
        run = run + F.when(grp >= F.lit(c), 1).otherwise(0)
    out = run
    for i, g in enumerate(alone):
        out = F.when(grp == F.lit(g), len(cuts) + 1 + i).otherwise(out)
    return out.cast("int")


def slots(rows: DataFrame, n_rows: int, k: int) -> DataFrame:
    """Number the rows of each shard from 0 without a gap.  A shard may hold a
    third of all rows, so it is dealt into parts by id; parts are counted, the
    counts give each part its first number, and each part is numbered alone."""
    parts = max(256, -(-n_rows // (k * SLOT_ROWS)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(parts)).cast("int"))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select("shard", "part", (F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n")).alias("first"))
    own = F.row_number().over(W.partitionBy("shard", "part").orderBy("doc_id", "grp", "size")) - 1
    return (rows.withColumn("own", own).join(first, ["shard", "part"])
                .withColumn("slot", (F.col("first") + F.col("own")).cast("long")))


def shard(df: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, grp, shard, slot of every row."""
    rows = stored(text_rows(df, id_col, text_col), "shard_rows")
    groups = stored(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard_groups")
    alone, cuts = plan(groups.select("grp", "bytes"), k)
    n = int(groups.agg(F.sum("n")).first()[0] or 0)
    return slots(rows.withColumn("shard", shard_column(alone, cuts, F.col("grp"))), n, k)


SHARDS = 40


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard"))


QUERIES = {"op10_minimax_shards": op10_minimax_shards}
SQL: dict[str, str] = {}
