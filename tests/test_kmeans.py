import numpy as np
import pytest

from loglens.operators import clustering as CL
from loglens.operators import kmeans as KM


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.6, (60, 3)) for c in ([0, 0, 0], [4, 0, 0], [0, 5, 0], [4, 5, 1])] + [np.zeros((8, 3))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>").repartition(4).persist()
    return x, df


def plain_lloyd(x, c):
    while True:
        own = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        lab = own.argmin(axis=1)
        new = np.array([x[lab == j].mean(axis=0) if (lab == j).any() else c[j] for j in range(len(c))])
        if ((new - c) ** 2).sum() <= KM.TOL:
            return c, own.min(axis=1).sum()
        c = new


def test_best_of_starts_against_plain_lloyd(vectors):
    x, df = vectors
    sample = KM.sampled(df, "v", KM.SEED_ROWS, 42)
    assert sorted(map(tuple, sample)) == sorted(map(tuple, x))
    for k in (3, 4):
        runs = [plain_lloyd(x, KM.spread(sample, k, np.random.default_rng((42, k, s)))) for s in range(KM.STARTS)]
        got = KM.fit(df, "v", k)
        assert got.inertia <= min(i for _, i in runs) + 1e-6
        best = min(runs, key=lambda r: r[1])[0]
        assert np.allclose(sorted(map(tuple, got.centres)), sorted(map(tuple, best)))


def test_silhouette_against_all_pairs(vectors):
    x, df = vectors
    fits = KM.fit_each(df, "v", [3, 4, 7], starts=2)
    got = KM.silhouettes(df, "v", fits, rows=len(x))
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for k, f in fits.items():
        lab = ((x[:, None] - f.centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        s = []
        for i in range(len(x)):
            own = lab == lab[i]
            a = away[i, own].sum() / max(1, own.sum() - 1)
            b = min(away[i, lab == j].mean() for j in set(lab) - {lab[i]})
            s.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
        assert abs(got[k] - np.mean(s)) < 1e-6
    assert abs(KM.silhouettes(df, "v", fits, rows=100)[4] - got[4]) < 0.1


def test_search_finds_the_groups(vectors):
    _, df = vectors
    scores = CL.k_search(df, "v", default_k=10, max_k=8)
    assert [k for k, _ in scores] == [3, 4, 5, 6, 7] and CL.best_k(scores) == 4
    assert CL.k_search(df.limit(30), "v") == []


def test_equal_vectors_and_empty_input(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 9, "v array<double>")
    f = KM.fit(same, "v", 3, starts=2)
    assert f.inertia == 0 and (f.centres == [1.0, 2.0]).all() and KM.silhouettes(same, "v", {3: f}) == {3: 0.0}
    with pytest.raises(ValueError):
        KM.fit(spark.createDataFrame([], "v array<double>"), "v", 3)


def test_sums_travel_in_parts(spark, monkeypatch):
    df = spark.range(200).selectExpr("array(double(id), 1D) v").repartition(6)
    got = KM.summed(df, "v", lambda x: np.concatenate([x.sum(axis=0), np.full(2 * 16384, float(len(x)))]))
    assert got[:2].tolist() == [19900.0, 200.0] and len(got) == 2 + 2 * 16384 and (got[2:] == 200.0).all()
    assert KM.PART == 16384


def test_silhouette_takes_every_vector(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2600, 2)) * [1.0, 3.0]
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(3).persist()
    fits = {k: KM.Fit(x[:k], 0.0) for k in (3, 5)}
    got = KM.silhouettes(df, "v", fits)     # more vectors than a block has
    small = KM.silhouettes(df, "v", fits, rows=300)
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for k, f in fits.items():
        lab = ((x[:, None] - f.centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        hot = np.eye(k)[lab]
        sums, n = away @ hot, hot.sum(axis=0)
        a = sums[np.arange(len(x)), lab] / (n[lab] - 1)
        b = np.where(hot > 0, np.inf, sums / n).min(axis=1)
        want = ((b - a) / np.maximum(a, b)).mean()
        assert abs(got[k] - want) < 1e-6 and abs(small[k] - want) < 1e-6


def test_blocks_meet_side_by_side(spark, monkeypatch):
    """Sums of one block from several sides are added up."""
    x = np.random.default_rng(9).normal(size=(500, 4))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").persist()
    fits = {3: KM.Fit(x[:3], 0.0), 4: KM.Fit(x[3:7], 0.0)}
    whole = KM.silhouettes(df, "v", fits, rows=500)
    monkeypatch.setattr(KM, "SIDE", 400)
    parts = KM.silhouettes(df, "v", fits, rows=90)
    assert all(abs(whole[k] - parts[k]) < 1e-9 for k in fits)


def test_seeds_are_drawn_from_every_vector(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(size=(700, 3)), np.repeat(rng.normal(3.0, 1.0, (2, 3)), 50, axis=0)])
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(5).persist()
    every = KM.sampled(df, "v", len(x), 42)
    fits = KM.fit_each(df, "v", [3, 6], starts=3, max_iter=0)
    monkeypatch.setattr(KM, "SEED_ROWS", 100)
    keys = [(k, s) for k in (3, 6) for s in range(3)]
    got = KM.drawn(df, "v", keys, 42)
    assert all((got[key] == KM.spread(every, key[0], np.random.default_rng((42, *key)))).all() for key in keys)
    cut = KM.fit_each(df, "v", [3, 6], starts=3, max_iter=0)
    assert all((cut[k].centres == fits[k].centres).all() for k in fits)


def test_seeds_of_few_distinct_vectors(spark):
    df = spark.createDataFrame([([0.0, 1.0],)] * 70 + [([2.0, 2.0],)], "v array<double>").repartition(3)
    for (k, _), c in KM.drawn(df, "v", [(1, 0), (2, 0), (4, 0)], 42).items():
        assert c.shape == (k, 2) and len({tuple(v) for v in c}) == min(k, 2)
