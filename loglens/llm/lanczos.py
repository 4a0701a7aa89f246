"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The rows are centred integer vectors X (n x d).  Starting from a unit vector
v1, steps alternate u = Xv and w = X'u on Spark, each new u and w cleared of all
earlier ones (full reorthogonalisation), so that U'XV = B is upper bidiagonal.
The SVD of the small B gives the components V*Q and the deviations s / sqrt(n).

The left vectors have one entry per row and are never stored: every one is X
times a known vector of d entries, so a task has their entries of a row at hand
by one small product.  A step is then a single pass: a task multiplies its rows
with the new and all earlier right-hand sides and returns sums of d + j + 1
numbers, which Spark adds up by position.  The driver holds d x d numbers.

When a residual vanishes (an eigenvalue of some multiplicity, or a rank below
d), the next step starts from a random vector orthogonal to all earlier ones.
Steps end at d, or as soon as the wanted components have converged and so has the
largest of a part that was started anew after that.

Defined results: a row takes part if its vector is not null, has no null or
non-finite entry, every floor(64 c) fits a long, and it has the most frequent
length (ties: the longer); the others are left out.  Null and repeated ids are
rows of their own.  Directions without deviation (a rank below d, one row, equal
rows) have no component; an empty table gives an empty result.  ``deviation``
is exact, and null where it doesn't fit a long.  Other columns never matter.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, pick, stored, table

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Bytes of a stored block of rows, about.
BLOCK_BYTES = 1 << 16
#: A residual below this share of the largest deviation counts as none.
TINY = 1e-12
#: A component is converged when its residual is below this share of the largest.
DONE = 1e-14
LIMIT = 2.0**62


# --------------------------------------------------------------------- rows

def integer_rows(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows that take part."""
    c = F.col("v").cast("array<double>")
    fits = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LIMIT / SCALE)
    rows = pick(df, vec_id=id_col, v=vec_col).select("vec_id", c.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", fits))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()    # one row
    return rows.filter(F.size("v") == (top["d"] if top else 0)).select(
        "vec_id", F.transform("v", lambda e: F.floor(e * SCALE) + F.lit(SHIFT)).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocked(rows: DataFrame) -> DataFrame:
    """(n, x binary): rows side by side as int64, less SHIFT."""
    def run(batches):
        for b in batches:
            x = matrix(b.column(0)).astype(np.int64) - SHIFT
            m = max(1, BLOCK_BYTES // (8 * x.shape[1]))
            parts = [x[i:i + m] for i in range(0, len(x), m)]
            yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], ["n", "x"])

    return map_arrow(rows.select("x"), run, "n long, x binary")


def summed(blocks: DataFrame, fn) -> np.ndarray:
    """Sum of fn(rows of a block) over all blocks; a task adds up its own,
    Spark the tasks' by position."""
    def run(batches):
        total = None
        for b in batches:
            for n, raw in zip(b.column("n").to_pylist(), b.column("x").to_pylist()):
                part = fn(np.frombuffer(raw, np.int64).reshape(n, -1))
                total = part if total is None else total + part
        if total is not None:
            flat = np.asarray(total).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat, pa.float64())], ["i", "value"])

    sums = map_arrow(blocks, run, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()   # as long as fn's result
    out = np.zeros(len(sums))
    for r in sums:
        out[r["i"]] = r["value"]
    return out


def totals(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, exact sums by dimension less n * SHIFT)."""
    def run(batches):
        n, s = 0, [0] * d
        for b in batches:
            for m, raw in zip(b.column("n").to_pylist(), b.column("x").to_pylist()):
                x = np.frombuffer(raw, np.int64).reshape(m, -1)
                n += m
                small = int(np.abs(x).max()) < 2**62 // m
                s = [a + int(c) for a, c in zip(s, x.sum(axis=0) if small else x.astype(object).sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([str(v) for v in [n, *s]])], ["i", "value"])

    sums = map_arrow(blocks, run, "i int, value string").groupBy("i").agg(F.sum(F.col("value").cast("decimal(28,0)")).alias("value")).collect()
    got = {r["i"]: int(r["value"]) for r in sums}
    return got.get(0, 0), [got.get(i + 1, 0) for i in range(d)]


# ------------------------------------------------------------ factorisation

class Centre:
    """x - S/n to double precision: whole part first, then the rest."""

    def __init__(self, n: int, sums: list[int]):
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest


@dataclass
class Components:
    n: int
    sums: list[int]
    vectors: np.ndarray         # d x k, by falling deviation
    deviations: np.ndarray      # k
    trace: float


def orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v less its share in the basis, cleared twice."""
    for _ in range(2 if basis else 0):
        b = np.array(basis)
        v = v - b.T @ (b @ v)
    return v


def bidiagonalised(blocks: DataFrame, centre: Centre, d: int, k: int, scale: float, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): X V = U B with orthonormal columns of U and V, as far as the
    leading k singular values of X need it.  ``scale`` is the root of the sum of
    all squares."""
    rng = np.random.default_rng(seed)
    fresh = lambda: rng.standard_normal(d)
    v = fresh()
    v /= np.linalg.norm(v)
    V: list[np.ndarray] = []        # right vectors
    P: list[np.ndarray] = []        # u_i = X p_i
    T: list[np.ndarray] = []        # X' u_i
    alpha: list[float] = []
    beta: list[float] = []          # beta[j]: between u_j and v_(j+1)
    begun = 0                       # first step of the part at work
    while True:
        q = v - beta[-1] * P[-1] if V and P[-1] is not None and beta[-1] else v
        live = [i for i, p in enumerate(P) if p is not None]
        sides = np.array([q, *(P[i] for i in live)]).T

        def step(x, sides=sides):
            y = centre(x)
            u = y @ sides
            return np.concatenate([y.T @ u[:, 0], u.T @ u[:, 0]])

        out = summed(blocks, step)
        w, own, h = out[:d], out[d], out[d + 1:]
        for i, c in zip(live, h):                   # clear u of all earlier left vectors
            q, w = q - c * P[i], w - c * T[i]
        a = float(np.sqrt(max(0.0, own - h @ h)))
        V.append(v)
        if a <= TINY * scale:                       # X v lies in the span of the earlier ones
            alpha.append(0.0)
            P.append(None)
            T.append(np.zeros(d))
            r = np.zeros(d)
        else:
            alpha.append(a)
            P.append(q / a)
            T.append(w / a)
            r = orthogonal(T[-1] - a * v, V)
        size = float(np.linalg.norm(r))
        steps = len(V)
        if steps == d:
            break
        gone = size <= TINY * scale
        left, s, _ = np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))
        own_left, own_s, _ = np.linalg.svd(np.diag(alpha[begun:]) + np.diag(beta[begun:], 1))
        end = 0.0 if gone else size / max(s[0], TINY * scale)
        settled = steps >= k and bool((end * np.abs(left[-1, :k]) <= DONE).all()) and bool(end * abs(own_left[-1, 0]) <= DONE)
        if begun and settled and own_s[0] < s[k - 1]:
            break
        if gone or settled:             # look for what the parts so far can't reach
            begun, size = steps, 0.0
            v = orthogonal(fresh(), V)
            v = orthogonal(v / np.linalg.norm(v), V)
            v /= np.linalg.norm(v)
        else:
            v = r / size
        beta.append(size)
    return np.array(V).T, np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1)


def fitted(blocks: DataFrame, d: int, k: int = COMPONENTS) -> Components:
    n, sums = totals(blocks, d)
    empty = Components(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    if n == 0:
        return empty
    centre = Centre(n, sums)
    squares = float(summed(blocks, lambda x: np.array([(centre(x) ** 2).sum()]))[0])
    if squares == 0.0:
        return empty
    k = min(k, d)
    V, B = bidiagonalised(blocks, centre, d, k, np.sqrt(squares))
    _, s, Qt = np.linalg.svd(B)
    keep = s[:k] > 1e-9 * s[0]
    return Components(n, sums, (V @ Qt.T)[:, :k][:, keep], s[:k][keep] / np.sqrt(n), squares / n)


# ----------------------------------------------------------------- whitening

def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2, None if beyond a long."""
    s = np.array(sums, dtype=object)
    far = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums)) if x.size else 0
    if far < 2**62 and far * far * x.shape[1] < 2**62:
        y = n * x - s.astype(np.int64)
        return (y * y).sum(axis=1).tolist()
    y = n * x.astype(object) - s
    return [v if v < 2**63 else None for v in (y * y).sum(axis=1).tolist()]


def whitened(rows: DataFrame, fit: Components) -> DataFrame:
    """vec_id, deviation, whitened array<double> (one entry a component)."""
    centre, n, sums = Centre(fit.n, fit.sums), fit.n, fit.sums
    side = fit.vectors / fit.deviations

    def run(batches):
        for b in batches:
            x = matrix(b.column(1)).astype(np.int64) - SHIFT
            y = centre(x) @ side
            ends = pa.array(np.arange(0, y.size + 1, y.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(deviations(x, n, sums), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(y.reshape(-1)))], ["vec_id", "deviation", "whitened"])

    return map_arrow(rows.select("vec_id", "x"), run, T.StructType([
        rows.schema["vec_id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]))


def identity_error(blocks: DataFrame, fit: Components) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    centre, k, side = Centre(fit.n, fit.sums), len(fit.deviations), fit.vectors / fit.deviations

    def products(x):
        y = centre(x) @ side
        return np.concatenate([y.sum(axis=0), (y.T @ y).reshape(-1)])

    out = summed(blocks, products)
    mean = out[:k] / fit.n
    return float(np.abs(out[k:].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)).max())


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitening(df: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = stored(integer_rows(df, id_col, vec_col), "whiten_rows")
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return spark.createDataFrame([], RESULT).withColumn("vec_id", F.col("vec_id").cast(rows.schema["vec_id"].dataType))
    blocks = stored(blocked(rows), "whiten_blocks")
    fit = fitted(blocks, first["d"], k)
    if not len(fit.deviations):
        return spark.createDataFrame([], RESULT).withColumn("vec_id", F.col("vec_id").cast(rows.schema["vec_id"].dataType))
    error = identity_error(blocks, fit)
    shares = F.array(*[F.lit(float(s * s / fit.trace)) for s in fit.deviations])
    out = whitened(rows, fit).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return out.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_lanczos_whitening": op12_lanczos_whitening}
SQL: dict[str, str] = {}
