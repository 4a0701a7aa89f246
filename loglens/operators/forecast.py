"""Next-step forecaster for minute sequences: ridge vector autoregression.

Predicts row t (d features) from the previous ``seq_length`` rows flattened
(plus a bias).  Fitting needs only the Gram matrices XᵀX and XᵀY: each task
sums them over its sequences in ``mapInPandas``, the partial entries are
summed by a ``groupBy`` on the entry index (so only (p+1)² + (p+1)·d numbers
per task cross the shuffle), and the small system is solved once.  For series
with many features :func:`fit_gradients` solves the same system by conjugate
gradients: a pass sums Xᵀ(X V) for the directions V of all targets, so tasks and
driver hold (p+1)·d numbers and never a (p+1)² matrix.  The same inputs, outputs
and anomaly rule as the sequence detector (MAE per sequence, p95 threshold) apply.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _design(pdf: pd.DataFrame, x: str, y: str):
    """Inputs with a column of ones, and outputs, as matrices."""
    ys = np.vstack(pdf[y].to_numpy()).astype(float)
    xs = np.concatenate(pdf[x].explode().to_numpy()).astype(float).reshape(len(pdf), -1)
    return np.hstack([xs, np.ones((len(xs), 1))]), ys


def fit_ridge(seqs: DataFrame, x: str = "x", y: str = "y", l2: float = 1e-3) -> np.ndarray:
    """Coefficients W ((p+1) × d) of y ≈ [x, 1] W."""
    def partial(it):
        g = b = None
        for pdf in it:
            if len(pdf):
                xs, ys = _design(pdf, x, y)
                g = xs.T @ xs + (0 if g is None else g)
                b = xs.T @ ys + (0 if b is None else b)
        if g is not None:
            vals = np.concatenate([g.ravel(), b.ravel()])
            yield pd.DataFrame({"i": np.arange(len(vals), dtype="int64"), "v": vals, "p": g.shape[0], "d": b.shape[1]})

    parts = seqs.select(x, y).mapInPandas(partial, "i long, v double, p long, d long")
    tot = parts.groupBy("i", "p", "d").agg(F.sum("v").alias("v")).toPandas()  # model-sized
    if tot.empty:
        raise ValueError("no sequences to fit")
    p, d = int(tot["p"].iloc[0]), int(tot["d"].iloc[0])
    vals = tot.sort_values("i")["v"].to_numpy()
    g = vals[: p * p].reshape(p, p)
    b = vals[p * p:].reshape(p, d)
    return np.linalg.solve(g + l2 * np.eye(p), b)


def _summed(seqs: DataFrame, x: str, y: str, fn) -> np.ndarray:
    """Sum of the matrices fn(inputs, outputs) over all sequences: a task adds up
    its own, Spark the tasks' by position."""
    def partial(it):
        total = None
        for pdf in it:
            if len(pdf):
                part = fn(*_design(pdf, x, y))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(total.size, dtype="int64"), "v": total.ravel(), "d": total.shape[1]})

    out = (seqs.select(x, y).mapInPandas(partial, "i long, v double, d long")
           .groupBy("i", "d").agg(F.sum("v").alias("v")).toPandas())     # as large as fn's result
    if out.empty:
        raise ValueError("no sequences to fit")
    return out.sort_values("i")["v"].to_numpy().reshape(-1, int(out["d"].iloc[0]))


def fit_gradients(seqs: DataFrame, x: str = "x", y: str = "y", l2: float = 1e-3, tol: float = 1e-10, max_passes: int = 2000) -> np.ndarray:
    """The coefficients of :func:`fit_ridge` by conjugate gradients, preconditioned by
    the diagonal; every pass advances all targets.  Each target ends at a residual of
    ``tol`` times its right side; ``RuntimeError`` if ``max_passes`` don't suffice.
    ``seqs`` is read once a pass and should be persisted."""
    first = _summed(seqs, x, y, lambda a, b: np.hstack([a.T @ b, (a * a).sum(axis=0)[:, None]]))
    b, diagonal = first[:, :-1], first[:, -1:] + l2
    w = np.zeros_like(b)
    r = b.copy()
    z = r / diagonal
    v, rz = z.copy(), (r * z).sum(axis=0)
    goal = tol * np.sqrt((b * b).sum(axis=0))
    for _ in range(max_passes):
        live = np.sqrt((r * r).sum(axis=0)) > goal
        if not live.any():
            return w
        sent = v[:, live]
        product = _summed(seqs, x, y, lambda a, _: a.T @ (a @ sent)) + l2 * sent
        step = rz[live] / (sent * product).sum(axis=0)
        w[:, live] += step * sent
        r[:, live] -= step * product
        z = r / diagonal
        new = (r * z).sum(axis=0)
        v = z + np.where(live, new / np.where(rz > 0, rz, 1.0), 0.0) * v
        rz = new
    raise RuntimeError(f"no solution within {max_passes} passes")


SOLVERS = {"gram": fit_ridge, "gradients": fit_gradients}


def forecast_errors(seqs: DataFrame, w: np.ndarray, x: str = "x", y: str = "y") -> DataFrame:
    """Adds ``error`` (mean absolute error over features) and ``sq_error`` (mean squared)."""
    schema = T.StructType(seqs.schema.fields + [T.StructField("error", T.DoubleType()),
                                                T.StructField("sq_error", T.DoubleType())])

    def run(it):
        for pdf in it:
            if len(pdf) == 0:
                yield pdf.assign(error=pd.Series(dtype=float), sq_error=pd.Series(dtype=float))
                continue
            xs, ys = _design(pdf, x, y)
            diff = xs @ w - ys
            yield pdf.assign(error=np.abs(diff).mean(axis=1), sq_error=(diff ** 2).mean(axis=1))

    return seqs.mapInPandas(run, schema)
