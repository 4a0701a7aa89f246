import numpy as np
import pytest

from loglens.llm import nndescent as N

LAST = 2**63 - 1


def brute(rows, threshold=0.9):
    ok = [(LAST if i is None else i, np.array(v, float)) for i, v in rows
          if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and np.linalg.norm(np.array(v, float)) > 0]
    up = {LAST if i is None else i: LAST if i is None else i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    n = [0] * len(ok)
    for a in range(len(ok)):
        for b in range(a):
            (i, x), (j, y) = ok[a], ok[b]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                n[a] += 1
                n[b] += 1
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    good = [(i, n[k], root(i)) for k, (i, _) in enumerate(ok)]
    return sorted(good + [(LAST if i is None else i, 0, LAST if i is None else i) for i, v in rows if (LAST if i is None else i) not in {g[0] for g in good}])


def vectors_of(rng, n):
    centres = rng.standard_normal((6, 16))
    return [(int(i), (centres[i % 6] + rng.standard_normal(16) * (0.25 if i % 3 else 2.0)).tolist()) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_links_and_components(spark, monkeypatch, small):
    if small:       # block pairs inside components
        monkeypatch.setattr(N, "COUNT_BLOCK", 16)
        monkeypatch.setattr(N, "BLOCK", 64)
        monkeypatch.setattr(N, "CODE_SIZE", 20)
    rows = vectors_of(np.random.default_rng(5), 300)
    rows += [(1000 + i, rows[0][1]) for i in range(4)] + [(2000, (2 * np.array(rows[0][1])).tolist())]
    got = sorted(map(tuple, N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == brute(rows)


def test_edge_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, v), (None, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [float("nan"), 1.0, 1.0]),
            (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (10, [2.0, 4.0]), (11, [-1.0, -2.0, -3.0])]
    docs = spark.createDataFrame([(i, x, "e", i, 0) for i, x in rows], "vec_id long, embedding array<double>, EMBEDDING string, id long, comp int")
    assert sorted(map(tuple, N.near_duplicates(docs).collect())) == brute(rows)
    assert N.near_duplicates(docs.limit(0)).collect() == []
    assert sorted(map(tuple, N.near_duplicates(docs.filter("vec_id IN (3, 4)")).collect())) == [(3, 0, 3), (4, 0, 4)]


def test_low_recall_widens_the_search(spark, monkeypatch):
    calls = []
    real = N.neighbour_graph
    monkeypatch.setattr(N, "neighbour_graph", lambda *a: calls.append(a[2:5]) or real(*a))
    answers = iter([0.5, 1.0])
    monkeypatch.setattr(N, "audited", lambda *a: next(answers))
    rows = vectors_of(np.random.default_rng(6), 60)
    got = sorted(map(tuple, N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == brute(rows) and calls == [(N.K, N.TABLES, N.BLOCK), (2 * N.K, 2 * N.TABLES, 2 * N.BLOCK)]


def test_audit_counts_missing_links(spark):
    rows = vectors_of(np.random.default_rng(7), 120)
    reps = N.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").selectExpr("id", "vec", "1L AS weight")
    true = {i: n for i, n, _ in brute(rows)}
    half = spark.createDataFrame([(i, n // 2) for i, n in true.items()], "id long, links long")
    assert abs(N.audited(reps, half, 0.9) - sum(n // 2 for n in true.values()) / sum(true.values())) < 1e-9


def test_two_tight_groups_with_links_between_them(spark):
    rng = np.random.default_rng(8)
    basis = np.linalg.qr(rng.standard_normal((32, 32)))[0]
    a, b = basis[0], 0.92 * basis[0] + np.sqrt(1 - 0.92 ** 2) * basis[1]
    rows = [(i, (c + 0.008 * rng.standard_normal(32)).tolist()) for i, c in enumerate([a] * 40 + [b] * 40 + [basis[2]] * 20)]
    assert sorted(map(tuple, N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())) == brute(rows)


def test_merged_components_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(N, "BALL_BLOCK", (16, 16))
    monkeypatch.setattr(N, "COUNT_BLOCK", 16)
    rng = np.random.default_rng(9)
    rows = vectors_of(rng, 200) + [(500, [1.0, 2.0]), (501, [2.0, 4.1])]
    reps = N.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    for comp in ("id", "CASE WHEN id < 200 THEN id % 6 + 6 * (id % 3) ELSE id END"):
        to = dict(map(tuple, N.merged(reps.selectExpr("id", f"{comp} AS comp", "vec"), 0.9).collect()))
        if comp == "id":
            assert {i: to.get(i, i) for i, _ in rows} == {i: c for i, _, c in brute(rows)}
        else:
            assert to[500] == to[501] == 500


def test_all_pairs_of_a_list_are_handed_on(spark):
    rng = np.random.default_rng(10)
    rows = [(i, (np.eye(16)[0] + 0.1 * rng.standard_normal(16)).tolist()) for i in range(13)]
    reps = N.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    graph = lambda new: spark.createDataFrame([(0, i, 0.5, new(i)) for i in range(1, 13)] + [(i, 0, 0.5, new(i)) for i in range(1, 13)], "u long, v long, sim double, new int")
    pairs = lambda g: {tuple(r)[:2] for r in N.descended(g, reps, N.K).collect()}
    every = {(a, b) for a in range(1, 13) for b in range(1, 13) if a != b}
    assert pairs(graph(lambda i: 1)) == every
    assert pairs(graph(lambda i: int(i == 3))) == {p for p in every if 3 in p}
    assert pairs(graph(lambda i: 0)) == set()


def test_last_resort_compares_all_vectors(spark, monkeypatch):
    searches = []
    monkeypatch.setattr(N, "neighbour_graph", lambda reps, *a: searches.append(a) or spark.createDataFrame([], "u long, v long, sim double"))
    rows = vectors_of(np.random.default_rng(11), 150)
    got = sorted(map(tuple, N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == brute(rows) and len(searches) == N.SEARCHES


def test_audit_by_vector_sees_what_a_hot_group_hides(spark):
    rng = np.random.default_rng(12)
    hot, pairs = np.eye(24)[0], rng.standard_normal((40, 24))
    rows = [(i, (hot + 0.02 * rng.standard_normal(24)).tolist()) for i in range(400)]
    rows += [(1000 + 2 * i + j, (p + 0.01 * rng.standard_normal(24)).tolist()) for i, p in enumerate(pairs) for j in (0, 1)]
    reps = N.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").selectExpr("id", "vec", "1L AS weight")
    lost = spark.createDataFrame([(i, 399 if i < 1000 else 0) for i, _ in rows], "id long, links long")
    assert N.audited(reps, lost, 0.9) > N.RECALL
    labelled = lambda comp: N.audited_vectors(reps.selectExpr("id", f"{comp} AS comp", "vec"), len(rows), 0.9)
    assert labelled("IF(id < 1000, 0, id)") < N.RECALL
    assert labelled("IF(id < 1000, 0, id - id % 2)") == 1.0
