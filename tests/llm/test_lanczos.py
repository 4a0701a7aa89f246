import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglens.llm import lanczos as L

SCHEMA = "vec_id long, embedding array<float>, label int, EMBEDDING string, x string, i int, whitened int"
NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "E", "x", 1, 2) for i, v in rows], SCHEMA).repartition(3)


def brute(rows):
    """{id: x} and (n, eigenvalues, vectors) of the covariance, by numpy."""
    X = np.array([[math.floor(64 * c) + 1_000_000 for c in map(float, np.float32(v))] for _, v in rows], dtype=object)
    n, S = len(X), X.sum(axis=0)
    C = (n * X - S).astype(float) / n
    e, W = np.linalg.eigh(C.T @ C / n)
    dev = ((n * X - S) ** 2).sum(axis=1)
    return n, dev, C, e[::-1], W[:, ::-1]


def checked(got, rows, k):
    n, dev, C, e, W = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by) == sorted(i for i, _ in rows) and all(sorted(m) == list(range(1, k + 1)) for m in by.values())
    Y = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    assert [by[i][1].deviation for i, _ in rows] == dev.tolist()
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    assert np.abs(Y.T @ Y / n - np.eye(k)).max() < 1e-9
    explained = np.array([by[rows[0][0]][c].explained for c in range(1, k + 1)])
    assert np.allclose(explained, e[:k] / e.sum(), rtol=1e-9)
    return Y, C @ W[:, :k] / np.sqrt(e[:k])


@pytest.mark.parametrize("d,n", [(64, 700), (5, 40), (40, 25)])
def test_against_eigenvectors(spark, d, n):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((n, d)) * np.linspace(3, 0.2, d) + rng.standard_normal(d) * 50
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    k = min(32, d, n - 1)
    Y, want = checked(L.whitening(frame(spark, rows)).select(*NAMES).collect(), rows, k)
    sign = np.sign((Y * want).sum(axis=0))
    assert np.abs(Y - want * sign).max() < 1e-7


def test_equal_eigenvalues_and_low_rank(spark):
    corners = [[a * 4.0, b * 4.0, c * 4.0, (a + b) * 4.0, 7.0] for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    rows = list(enumerate(corners))
    checked(L.whitening(frame(spark, rows)).collect(), rows, 3)
    same = [(i, [float(j == i % 6) for j in range(6)]) for i in range(60)]       # five equal eigenvalues
    checked(L.whitening(frame(spark, same)).collect(), same, 5)


def test_early_end_finds_equal_leading_values(spark, monkeypatch):
    passes = []
    summed = L.summed
    monkeypatch.setattr(L, "summed", lambda *a: passes.append(1) or summed(*a))
    rng = np.random.default_rng(3)
    x = np.concatenate([np.eye(40)[:2] * 200, -np.eye(40)[:2] * 200, rng.integers(-1, 2, (30, 40)) / 64.0])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    Y, want = checked(L.whitening(frame(spark, rows), k=2).collect(), rows, 2)
    assert len(passes) < 36         # 43 for all 40 dimensions


def test_left_out_rows_and_exact_sums(spark):
    rng = random.Random(8)
    good = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan")] * 4), (103, [float("inf"), 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0, 0.0])]
    checked(L.whitening(frame(spark, good + bad)).collect(), good, 4)
    twice = L.whitening(frame(spark, good + [(None, good[3][1]), (3, good[3][1])]))
    assert twice.count() == 32 * 4 and twice.filter("vec_id IS NULL").count() == 4
    assert {r.n for r in twice.select("n").distinct().collect()} == {32}
    far = [(i, [float(2**50 * (i + 1)), float(i)]) for i in range(4)]
    assert {r.deviation for r in L.whitening(frame(spark, far)).collect()} == {None}
    assert L.deviations(np.array([[2**31, 0]]), 3, [0, 0]) == [None] and L.deviations(np.array([[2**30, 0]]), 2, [0, 1]) == [2**62 + 1]


def test_tables_without_deviation(spark):
    assert L.whitening(frame(spark, [])).columns == NAMES and L.whitening(frame(spark, [])).collect() == []
    assert L.whitening(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert L.whitening(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    other = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [2.0, 9.0])], "name string, v array<double>")
    got = L.whitening(other, id_col="name", vec_col="v").agg(F.min("vec_id"), F.count("*")).first()
    assert tuple(got) == ("a", 2)
