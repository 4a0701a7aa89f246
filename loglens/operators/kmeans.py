"""k-means with restarts, and the Euclidean silhouette, in passes over the data.

All starts (of one k, or of every candidate k) advance together: one pass
assigns each vector to its nearest centre of every start and returns sums by
start and cluster, which Spark adds up.  A start that has settled leaves the
passes; the best inertia of a k is kept.

Seeds are those of k-means++ over all vectors, in the order of their hashes: up to
SEED_ROWS of them on the driver, more by passes that make the same draws.  The
silhouette is that of *all* vectors, from the distances of all pairs: blocks
of vectors meet each other, and the distances of each vector are summed by
cluster, for every candidate k at once.  Vectors are arrays of one width without
nulls, or sparse ones (``sparse.entries``), which a worker widens a few at a time.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import KMEANS_K, SEED
from ..session import checkpointed
from . import sparse as SP

STARTS = 10
MAX_ITER = 300
#: Summed squares by which a settled start's centres move at most.
TOL = 1e-4
#: As many vectors the driver seeds itself.
SEED_ROWS = 4000
#: Vectors of a block of the silhouette, and places of the vectors a task compares a block with.
BLOCK_ROWS = 2000
SIDE = 1 << 22


@dataclass
class Fit:
    """``centres`` k × d and the sum of squared distances to them."""
    centres: np.ndarray
    inertia: float

    def frame(self, spark: SparkSession) -> DataFrame:
        """(cluster, centre), one row a centre."""
        return SP.centre_table(spark, self.centres).select("cluster", "centre")


def matrix(column: pd.Series) -> np.ndarray:
    if isinstance(column.iloc[0], dict):
        return SP.widened(column)
    return np.vstack(column.to_numpy()).astype(float)


def by_hash(vec: str, seed: int) -> list:
    return [F.xxhash64(F.lit(seed), vec), F.col(vec)]


def sampled(df: DataFrame, vec: str, n: int, seed: int) -> np.ndarray:
    """At most n vectors, those of the lowest seeded hash."""
    rows = df.select(vec).orderBy(*by_hash(vec, seed)).limit(n).collect()
    if rows and hasattr(rows[0][0], "idx"):
        return SP.widened(pd.Series([r[0].asDict() for r in rows]))
    return np.array([r[0] for r in rows], dtype=float)


def spread(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each next seed with a chance by its squared distance to the others."""
    seeds = [sample[rng.integers(len(sample))]]
    near = ((sample - seeds[0]) ** 2).sum(axis=1)
    while len(seeds) < k:
        total = near.sum()
        p = near / total if total > 0 else None
        seeds.append(sample[rng.choice(len(sample), p=p)])
        near = np.minimum(near, ((sample - seeds[-1]) ** 2).sum(axis=1))
    return np.array(seeds)


def sq_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2.0 * (x @ c.T), 0.0)


def near(x: np.ndarray, seeds: list[np.ndarray]) -> np.ndarray:
    """By start: squared distance of each vector to the nearest seed, 1 if there is none yet."""
    return np.stack([sq_distances(x, c).min(axis=1) if len(c) else np.ones(len(x)) for c in seeds], axis=1)


def chunks(it, vec: str):
    """Matrices of a task's vectors, SP.CHUNK rows at a time."""
    for pdf in it:
        for at in range(0, len(pdf), SP.CHUNK):
            yield matrix(pdf[vec].iloc[at:at + SP.CHUNK])


def weights(df: DataFrame, vec: str, seeds: list[np.ndarray]) -> np.ndarray:
    """Sums of :func:`near`, partitions × starts."""
    def partial(it):
        total = np.zeros(len(seeds))
        for x in chunks(it, vec):
            total += near(x, seeds).sum(axis=0)
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "w": [total.tobytes()]})

    out = df.select(vec).mapInPandas(partial, "part int, w binary").toPandas()      # a row a partition
    sums = np.zeros((int(out["part"].max()) + 1, len(seeds)))
    for part, w in zip(out["part"], out["w"]):
        sums[part] = np.frombuffer(w)
    return sums


def at_weights(df: DataFrame, vec: str, seeds: list[np.ndarray], places: list[tuple[int, float]]) -> list[np.ndarray]:
    """For every start the vector at a place: a partition and a part of its weight
    there, the first vector with which the running sum of weights exceeds it."""
    def found(it):
        part = TaskContext.get().partitionId()
        mine = [j for j, (p, _) in enumerate(places) if p == part]
        open_, run, last = dict.fromkeys(mine), dict.fromkeys(mine, 0.0), {}
        for x in chunks(it, vec):
            live = list(open_)
            if not live:
                continue
            w = near(x, [seeds[j] for j in live])
            for j, own in zip(live, w.T):
                c = run[j] + own.cumsum()
                i = int(np.searchsorted(c, places[j][1], side="right"))
                if i < len(x):
                    del open_[j]
                    yield pd.DataFrame({"start": [j], "x": [x[i].tobytes()]})
                elif own.any():
                    last[j] = x[np.flatnonzero(own)[-1]].tobytes()
                run[j] = c[-1]
        for j in open_:     # the sum was rounded
            yield pd.DataFrame({"start": [j], "x": [last[j]]})

    out = df.select(vec).mapInPandas(found, "start int, x binary").toPandas()       # a row a start
    return [np.frombuffer(x) for x in out.sort_values("start")["x"]]


def drawn(df: DataFrame, vec: str, keys: list[tuple[int, int]], seed: int) -> dict[tuple[int, int], np.ndarray]:
    """Seeds of every (k, start) by :func:`spread` over all vectors in the order of
    their hashes, all starts together: for each next seed one pass that weighs
    the partitions and one that finds the vectors drawn."""
    order = [*by_hash(vec, seed), F.col("at")]
    data = df.select(vec).withColumn("at", F.monotonically_increasing_id())      # equal vectors need not stay together
    data = checkpointed(data.repartitionByRange(*order).sortWithinPartitions(*order).select(vec))
    rngs = {(k, s): np.random.default_rng((seed, k, s)) for k, s in keys}
    none = np.zeros((0, 0))
    sizes = weights(data, vec, [none])[:, 0]
    seeds = dict.fromkeys(keys, none)
    for t in range(max(k for k, _ in keys)):
        live = [key for key in keys if key[0] > t]
        sums = weights(data, vec, [seeds[key] for key in live]) if t else None
        by, places = [], []
        for j, key in enumerate(live):
            even = not t or not sums[:, j].sum() > 0
            ends = np.cumsum(sizes if even else sums[:, j])
            at = float(rngs[key].integers(int(ends[-1]))) if even else rngs[key].random() * ends[-1]
            part = min(int(np.searchsorted(ends, at, side="right")), int(np.searchsorted(ends, ends[-1])))
            by.append(none if even else seeds[key])
            places.append((part, at - (ends[part - 1] if part else 0.0)))
        for key, x in zip(live, at_weights(data, vec, by, places)):
            seeds[key] = np.vstack([seeds[key], x]) if t else x[None]
    return seeds


#: Places of a flat array that travel together.
PART = 1 << 14


def summed(df: DataFrame, vec: str, fn) -> np.ndarray:
    """Sum of the flat arrays fn(vectors) over all rows: a task adds up its own and
    hands them on in parts of PART places, not one row a place; Spark brings equal
    parts together."""
    def partial(it):
        total = None
        for x in chunks(it, vec):
            part = fn(x)
            total = part if total is None else total + part
        if total is not None:
            for i in range(0, len(total), PART):
                yield pd.DataFrame({"i": [i], "v": [total[i:i + PART].tobytes()]})

    def added(i, parts):
        total = np.frombuffer(parts["v"].iloc[0])
        for v in parts["v"].iloc[1:]:
            total = total + np.frombuffer(v)
        return pd.DataFrame({"i": [i[0]], "v": [total.tobytes()]})

    kind = "i long, v binary"
    out = df.select(vec).mapInPandas(partial, kind).groupBy("i").applyInPandas(added, kind).toPandas()   # as long as fn's result
    return np.concatenate([np.frombuffer(v) for v in out.sort_values("i")["v"]])


def one_hot(labels: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((len(labels), k))
    out[np.arange(len(labels)), labels] = 1.0
    return out


def lloyd_pass(df: DataFrame, vec: str, starts: list[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """(new centres, inertia of the given ones) of every start; a centre without
    vectors stays."""
    sizes, d = [len(c) for c in starts], starts[0].shape[1]
    ends = np.cumsum(sizes)
    every = np.vstack(starts)

    def step(x):
        d2 = sq_distances(x, every)
        sums, counts, inertia = np.zeros((len(every), d)), np.zeros(len(every)), np.zeros(len(sizes))
        for s, (k, end) in enumerate(zip(sizes, ends)):
            own = d2[:, end - k:end]
            hot = one_hot(own.argmin(axis=1), k)
            sums[end - k:end] = hot.T @ x
            counts[end - k:end] = hot.sum(axis=0)
            inertia[s] = own.min(axis=1).sum()
        return np.concatenate([sums.ravel(), counts, inertia])

    out = summed(df, vec, step)
    n = len(every)
    sums, counts, inertia = out[:n * d].reshape(n, d), out[n * d:n * d + n], out[n * d + n:]
    new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], every)
    return [(new[end - k:end], float(i)) for k, end, i in zip(sizes, ends, inertia)]


def fit_each(df: DataFrame, vec: str, ks: list[int], starts: int = STARTS, seed: int = SEED, max_iter: int = MAX_ITER) -> dict[int, Fit]:
    """The best of ``starts`` fits for each k, all of them advanced together."""
    first = sampled(df, vec, SEED_ROWS + 1, seed)
    if not len(first):
        raise ValueError("no vectors to fit")
    keys = [(k, s) for k in ks for s in range(starts)]
    live = (drawn(df, vec, keys, seed) if len(first) > SEED_ROWS else
            {(k, s): spread(first, k, np.random.default_rng((seed, k, s))) for k, s in keys})
    best: dict[int, Fit] = {}
    for turn in range(max_iter + 1):
        moved = lloyd_pass(df, vec, list(live.values()))
        for (key, old), (new, inertia) in zip(list(live.items()), moved):
            if ((new - old) ** 2).sum() > TOL and turn < max_iter:
                live[key] = new
                continue
            del live[key]
            if key[0] not in best or inertia < best[key[0]].inertia:
                best[key[0]] = Fit(old, inertia)
        if not live:
            return best
    return best


def fit(df: DataFrame, vec: str, k: int = KMEANS_K, starts: int = STARTS, seed: int = SEED, max_iter: int = MAX_ITER) -> Fit:
    return fit_each(df, vec, [k], starts, seed, max_iter)[k]


def wide(vecs: pa.Array) -> np.ndarray:
    """:func:`matrix` of an Arrow array."""
    if pa.types.is_struct(vecs.type):
        return matrix(vecs.to_pandas())
    return vecs.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vecs), -1)


def labelled_blocks(df: DataFrame, vec: str, rows: int, fits: list[Fit]) -> tuple[DataFrame, int, int]:
    """(block, own, vecs) with the number of vectors and of their places: all vectors
    in blocks of about ``rows``, one a partition; ``own`` has the cluster of each
    vector in every fit (int32).  Blocks are files, so they stay the same if a task runs again."""
    places = F.size(F.col(vec)["idx"] if isinstance(df.schema[vec].dataType, T.StructType) else F.col(vec))
    n, places = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(places), F.lit(0))).first()

    def packed(it):
        got = [b.column(0) for b in it if b.num_rows]
        if not got:
            return
        vecs = pa.concat_arrays(got)
        own = np.vstack([np.stack([sq_distances(x, f.centres).argmin(axis=1) for f in fits], axis=1)
                         for x in (wide(vecs[at:at + SP.CHUNK]) for at in range(0, len(vecs), SP.CHUNK))])
        yield pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([own.astype(np.int32).tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(vecs)], pa.int32()), vecs)], names=["block", "own", "vecs"])

    kind = T.StructType().add("block", "long").add("own", "binary").add("vecs", T.ArrayType(df.schema[vec].dataType))
    return checkpointed(df.select(vec).repartition(max(1, -(-n // rows))).mapInArrow(packed, kind)), n, places


def silhouette(sums: np.ndarray, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Silhouette of each vector from its summed distances to the clusters, its own
    cluster and the clusters' sizes."""
    at, mine = np.arange(len(own)), counts[own]
    a = sums[at, own] / np.maximum(mine - 1, 1)
    means = np.where(counts > 0, sums / np.maximum(counts, 1), np.inf)
    means[at, own] = np.inf
    b = means.min(axis=1)
    ok = (mine > 1) & np.isfinite(b) & (np.maximum(a, b) > 0)
    return np.where(ok, (np.where(ok, b, 0) - a) / np.where(ok, np.maximum(a, np.where(ok, b, 0)), 1), 0.0)


def silhouettes(df: DataFrame, vec: str, fits: dict[int, Fit], rows: int = BLOCK_ROWS) -> dict[int, float]:
    """Mean silhouette (Euclidean distances) of all vectors for each k; a vector alone
    in its cluster counts 0, one cluster alone gives 0.  ``rows`` is the size of the
    blocks that meet, not a limit: the time grows with the square of the vectors,
    what is shuffled (sums by vector and cluster, once a side) isn't made by pair."""
    ks = sorted(fits)
    ends = np.cumsum(ks)
    first = ends - ks
    blocks, n, places = labelled_blocks(df, vec, rows, [fits[k] for k in ks])
    sides = blocks.coalesce(max(1, -(-places // SIDE))).select(F.col("own").alias("theirs"), F.col("vecs").alias("others"))

    def owners(cell):
        return np.frombuffer(cell, np.int32).reshape(-1, len(ks))

    def row(block, own, sums, counts):
        return pa.RecordBatch.from_pydict({"block": [block], "own": [own], "sums": [sums.tobytes()], "counts": [counts.tobytes()]})

    def summed_up(it):
        now, own, x, sums, counts = None, None, None, None, None
        for batch in it:
            for block, mine, vecs, theirs, others in zip(*batch.columns):
                if block.as_py() != now:
                    if now is not None:
                        yield row(now, own, sums, counts)
                    now, own, x = block.as_py(), mine.as_py(), wide(vecs.values)
                    sums, counts = np.zeros((len(x), ends[-1])), np.zeros(ends[-1])
                theirs = owners(theirs.as_py())
                for at in range(0, len(theirs), SP.CHUNK):
                    y, places = wide(others.values[at:at + SP.CHUNK]), theirs[at:at + SP.CHUNK] + first
                    hot = np.zeros((len(y), ends[-1]))
                    hot[np.arange(len(y))[:, None], places] = 1.0
                    sums += np.sqrt(sq_distances(x, y)) @ hot
                    counts += hot.sum(axis=0)
        if now is not None:
            yield row(now, own, sums, counts)

    def scored(parts):
        own = owners(parts["own"].iloc[0])
        sums = sum(np.frombuffer(v) for v in parts["sums"]).reshape(len(own), -1)
        counts = sum(np.frombuffer(v) for v in parts["counts"])
        return pd.DataFrame({"k": ks, "s": [silhouette(sums[:, i:e], own[:, j], counts[i:e]).sum() for j, (i, e) in enumerate(zip(first, ends))]})

    sums = (blocks.crossJoin(sides.hint("shuffle_replicate_nl"))      # as many rows as pairs of blocks
            .mapInArrow(summed_up, "block long, own binary, sums binary, counts binary"))
    out = sums.groupBy("block").applyInPandas(scored, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").collect()
    return {r.k: r.s / n for r in out}
