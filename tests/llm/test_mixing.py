import itertools
import random

from loglens.llm import mixing


def test_targets_reshare_the_excess():
    t = mixing.targets({"a": 10, "b": 100, "c": 90}, {"a": 5, "b": 2, "c": 1}, 200, 3)
    assert t["a"] == 30 and abs(t["b"] - 170 * 2 / 3) < 1e-9 and abs(sum(t.values()) - 200) < 1e-9
    assert mixing.targets({}, {}, 0, 3) == {}
    assert mixing.targets({"a": 0}, {"a": 1}, 0, 3) == {"a": 0.0}


def test_flow_is_cheapest_by_brute_force():
    rng = random.Random(2)
    for _ in range(30):
        patterns = [(frozenset(m), rng.randint(1, 3)) for m in ("a", "b", "ab")]
        quotas = {"a": rng.randint(0, 6), "b": rng.randint(0, 6)}
        tokens, links = mixing.route(patterns, quotas, 3)
        price = lambda t, n: sum(1 + i // n for i in range(t))
        best = None
        for split in itertools.product(*[range(3 * n + 1) for _, n in patterns], range(3 * patterns[2][1] + 1)):
            a, b, ab, to_a = split
            if to_a > ab or a + to_a > quotas["a"] or b + ab - to_a > quotas["b"]:
                continue
            key = (-(a + b + ab), sum(price(t, n) for t, (_, n) in zip((a, b, ab), patterns)))
            best = min(best, key) if best else key
        assert (-sum(tokens), sum(price(t, n) for t, (_, n) in zip(tokens, patterns))) == best
        assert all(sum(v for (_, s), v in links.items() if s == q) <= quotas[q] for q in quotas)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = mixing.mix(edge_docs, mixing.WEIGHTS, seed=1).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    by = {}
    for r in got:
        by.setdefault(r["target"], []).append(r)
    largest = max(r["size"] for r in got)
    for target, rows in by.items():
        assert abs(sum(r["taken"] for r in rows) - target) <= largest
    assert abs(sum(by) - sum(r["size"] for r in got)) < 1e-6
    again = mixing.mix(edge_docs.repartition(5), mixing.WEIGHTS, seed=1).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(no_docs, mixing.WEIGHTS).collect() == []


def test_many_documents_come_near_the_targets(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), mixing.WEIGHTS, seed=3).collect()
    source = {i: s for i, _, s in rows}
    for s in ("a", "b", "c", None):
        mine = [r for r in got if source[r["doc_id"]] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 40


def test_rows_are_repeated(edge_docs, no_docs):
    taken = {(r["doc_id"], r["size"]): r["taken"] // r["size"] for r in mixing.mix(edge_docs, mixing.WEIGHTS, seed=1).collect() if r["size"]}
    out = mixing.mixed_rows(edge_docs, mixing.WEIGHTS, seed=1)
    assert out.columns == edge_docs.columns and out.count() >= sum(taken.values())
    assert mixing.mixed_rows(no_docs, mixing.WEIGHTS).collect() == []
