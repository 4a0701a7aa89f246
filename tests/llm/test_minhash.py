import itertools
import random

import numpy as np
import pytest

from loglens.llm import minhash as M
from loglens.llm.components import connected

LAST = 2**63 - 1


def brute(rows, width, percent):
    """{id: (shingles, component)}; rows with one id are one document."""
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[j:j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        sets.append((LAST if i is None else i, s))
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = root(i), root(j)
            up[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for i, s in sets)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    for width, percent in ((3, 85), (5, 80)):
        got = sorted(map(tuple, M.classes(edge_docs, width, percent).collect()))
        assert got == brute([r[:2] for r in edge_rows], width, percent)
    assert M.classes(no_docs).collect() == []


@pytest.mark.parametrize("pivots", [1, 64])
def test_a_large_group_of_variants(spark, monkeypatch, pivots):
    monkeypatch.setattr(M, "PIVOTS", pivots)
    rng = random.Random(8)
    base = [f"w{rng.randrange(300)}" for _ in range(110)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randrange(12)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(300)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"w{rng.randrange(300)}" for _ in range(90))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, M.classes(docs, 3, 85).collect())) == brute(rows, 3, 85)


def test_estimate_follows_the_similarity(spark):
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    from pyspark.sql import functions as F
    rows, want = [], []
    for share in (0, 500, 1000, 1500, 1900, 2000):
        a, b = pool[:2000], np.concatenate([pool[:share], pool[2000:4000 - share]])
        x = M.packed(M.minima([a, b]))
        rows.append((x[0].tolist(), x[1].tolist()))
        want.append(share / (4000 - share))
    got = spark.createDataFrame(rows, "a array<long>, b array<long>").select(M.estimate(F.col("a"), F.col("b"))).collect()
    assert max(abs(g[0] - w) for g, w in zip(got, want)) < 0.15 and got[-1][0] == 1.0


def test_minima_in_chunks(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (3, 0, 900, 1, 40)]
    whole = M.minima(sets)
    monkeypatch.setattr(M, "CHUNK", 64)
    assert (M.minima(sets) == whole).all()


def test_bands_miss_little():
    for percent in (80, 85, 95):
        r = M.band_rows(percent)
        assert (1 - (percent / 100) ** r) ** (M.K // r) <= M.MISS


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(500, 500)]
    got = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def kept_rows(rows, width=5, percent=80):
    """Of (id, text): sorted ids that stay, by row; null as LAST."""
    groups = {}
    for n, _, c in brute([(n, t) for n, (_, t) in enumerate(rows)], width, percent):
        groups.setdefault(c, []).append(LAST if rows[n][0] is None else rows[n][0])
    return sorted(min(g) for g in groups.values())


def test_one_of_each_group_stays(edge_docs, edge_rows, no_docs):
    out = M.deduplicated(edge_docs)
    assert out.columns == edge_docs.columns
    assert sorted(LAST if r[0] is None else r[0] for r in out.collect()) == kept_rows([r[:2] for r in edge_rows])
    assert M.deduplicated(no_docs).collect() == []


def test_rows_under_one_id_are_told_apart(spark):
    rng = random.Random(3)
    a, b, c, d = (" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (None, a), (None, b), (None, b), (None, c), (2, c), (2, d), (2, d), (3, None), (3, None), (None, "")]
    out = sorted(((LAST if r[0] is None else r[0]), r[1] or "") for r in M.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == sorted([(1, a), (LAST, b), (2, c), (2, d), (3, ""), (3, ""), (LAST, "")])
    unique = [(10 - i, t) for i, (_, t) in enumerate(rows)]
    got = sorted(r[0] for r in M.deduplicated(spark.createDataFrame(unique, "doc_id long, text string")).collect())
    assert got == kept_rows(unique)
