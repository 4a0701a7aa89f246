"""Isolation forest on Spark (Liu, Ting & Zhou, 2008).

fit:   each of ``n_trees`` trees draws ``psi = min(256, n)`` rows without
       replacement, chosen by the smallest ``xxhash64(key, tree, seed)``.  A row
       first keeps only the trees whose hash falls under a rate of ~2·psi/n, so
       the explode emits about 2·psi rows per tree instead of n.  Trees are grown
       by ``groupBy(tree_id).applyInPandas`` (one small group per tree), random
       feature and uniform split value, depth limit ceil(log2 psi).
score: path length averaged over trees, ``s = -2^(-E[h]/c(psi))`` in [-1, 0]
       (lower = more anomalous), computed in ``mapInPandas`` with the trees —
       a model of at most n_trees × (2^(depth+1)-1) nodes — shipped to the tasks.
label: anomalous when the score is below the ``contamination`` quantile of
       the training scores.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import FOREST_CONTAMINATION, FOREST_SAMPLE, FOREST_TREES, SEED

EULER = 0.5772156649015329

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()), T.StructField("depth", T.IntegerType()),
])


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n > 2:
        return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n
    if n == 2:
        return 1.0
    return 0.0


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx), depth])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.nonzero(hi > lo)[0]
        if len(cand) == 0:
            return me
        f = int(rng.choice(cand))
        s = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < s]
        right = idx[sub[:, f] >= s]
        nodes[me][0], nodes[me][1] = f, s
        nodes[me][2] = build(left, depth + 1)
        nodes[me][3] = build(right, depth + 1)
        return me

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


def fit_forest(df: DataFrame, key: str, vec: str, n_trees: int = FOREST_TREES,
               sample: int = FOREST_SAMPLE, seed: int = SEED) -> dict:
    """Returns the model: {'psi', 'trees': {tree_id: node arrays}}."""
    n = df.count()
    psi = int(min(sample, n))
    if psi < 1:
        raise ValueError("no training rows")
    rate = min(1.0, 2.0 * psi / n)
    bound = int(rate * 2 ** 31)
    h = lambda t: F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(2 ** 31))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: h(t) < F.lit(bound))
    cand = df.select(F.col(key), F.col(vec), F.explode(trees).alias("tree_id"))
    cand = cand.withColumn("_h", F.xxhash64(F.col(key), F.col("tree_id"), F.lit(seed)))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", key]).head(psi)
        tid = int(pdf["tree_id"].iloc[0])
        x = np.vstack(pdf[vec].to_numpy()).astype(float)
        rng = np.random.default_rng(seed * 1_000_003 + tid)
        rows = _grow(x, rng, max_depth)
        out = pd.DataFrame(rows, columns=["feature", "split", "left", "right", "size", "depth"])
        out.insert(0, "node", np.arange(len(rows), dtype="int32"))
        out.insert(0, "tree_id", tid)
        return out

    nodes = cand.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)
    pdf = nodes.toPandas()   # n_trees × ≤ 2^(depth+1) nodes: bounded by the model, not the data
    model = {"psi": psi, "trees": {}}
    for tid, g in pdf.groupby("tree_id"):
        g = g.sort_values("node")
        model["trees"][int(tid)] = {c: g[c].to_numpy() for c in ["feature", "split", "left", "right", "size", "depth"]}
    return model


def _path_lengths(x: np.ndarray, tree: dict) -> np.ndarray:
    node = np.zeros(len(x), dtype=np.int64)
    feat, split, left, right = tree["feature"], tree["split"], tree["left"], tree["right"]
    active = feat[node] >= 0
    while active.any():
        i = np.nonzero(active)[0]
        f = feat[node[i]]
        go_left = x[i, f] < split[node[i]]
        node[i] = np.where(go_left, left[node[i]], right[node[i]])
        active[i] = feat[node[i]] >= 0
    return tree["path"][node]


def score_forest(df: DataFrame, vec: str, model: dict, out: str = "anomaly_score") -> DataFrame:
    """Adds ``out`` = -2^(-E[h]/c(psi)) per row."""
    # length of the path that ends in a node, with what its rows would still need
    trees = [{**t, "path": t["depth"] + np.array([c_factor(float(s)) for s in t["size"]])} for t in model["trees"].values()]
    cpsi = c_factor(float(model["psi"])) or 1.0
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType())])

    def run(it):
        for pdf in it:
            if len(pdf) == 0:
                yield pdf.assign(**{out: pd.Series(dtype=float)})
                continue
            x = np.vstack(pdf[vec].to_numpy()).astype(float)
            depth = np.mean([_path_lengths(x, t) for t in trees], axis=0)
            yield pdf.assign(**{out: -np.power(2.0, -depth / cpsi)})

    return df.mapInPandas(run, schema)


def fit_offset(scored: DataFrame, col: str = "anomaly_score", contamination: float = FOREST_CONTAMINATION) -> float:
    """Score at the ``contamination`` quantile of the training scores (exact,
    interpolated).  The scores are one a window, so their number is bounded by the
    training time and one aggregate takes them."""
    return float(scored.agg(F.percentile(F.col(col), contamination)).first()[0])
