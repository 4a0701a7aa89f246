import random
import zlib

from loglens.llm import shards


def best_capacity(sizes, k):
    lo, hi = max(max(sizes), -(-sum(sizes) // k)), sum(sizes)
    while lo < hi:
        mid, n, at = (lo + hi) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                n, at = n + 1, 0
            at += s
        lo, hi = (lo, mid) if n <= k else (mid + 1, hi)
    return lo


def test_capacity_is_the_smallest(spark, monkeypatch):
    monkeypatch.setattr(shards, "FIRST_BITS", 2)      # many rounds of splitting
    rng = random.Random(3)
    for k in (1, 3, 7):
        keys = sorted({rng.randrange(-2**63, 2**63) for _ in range(300)})
        sizes = [rng.choice([1, 5, 40, 300]) for _ in keys]
        groups = spark.createDataFrame(list(zip(keys, sizes)), "grp long, bytes long")
        cap, cuts = shards.minimax_cuts(groups, k)
        assert cap == best_capacity(sizes, k)
        sums = [sum(s for g, s in zip(keys, sizes) if (a is None or g >= a) and (b is None or g < b)) for a, b in zip([None, *cuts], [*cuts, None])]
        assert max(sums) == cap and len(sums) <= k


def test_groups_of_their_own_never_need_more_than_the_full_order(spark, monkeypatch):
    monkeypatch.setattr(shards, "FIRST_BITS", 3)
    rng = random.Random(8)
    apart = []
    for case in range(5):
        k = rng.choice([2, 3, 5])
        keys = sorted({rng.randrange(-2**63, 2**63) for _ in range(14)})
        sizes = [rng.choice([1, 9, 30, 31, 60, 400]) for _ in keys]
        alone, cuts = shards.plan(spark.createDataFrame(list(zip(keys, sizes)), "grp long, bytes long"), k)
        sums = [0] * (k + 1)
        for g, s in zip(keys, sizes):
            at = len(cuts) + 1 + alone.index(g) if g in alone else sum(g >= c for c in cuts)
            sums[at] += s
        assert not sums[k] and max(sums) <= best_capacity(sizes, k)
        apart.append(bool(alone))
    assert len(set(apart)) == 2


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = shards.shard(edge_docs, 4).collect()
    assert len(got) == len(edge_rows)
    by_crc = {}
    for r in got:
        by_crc.setdefault((r["text_crc32"], r["size"], r["grp"]), set()).add(r["shard"])
        assert 0 <= r["shard"] < 4
    assert all(len(s) == 1 for s in by_crc.values())
    sizes = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in edge_rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sizes
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert shards.shard(no_docs, 4).collect() == []


def test_a_huge_group_stands_alone(spark):
    rows = [(i, "same" * 50) for i in range(400)] + [(1000 + i, f"text {i} " * 3) for i in range(800)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 5).groupBy("shard").sum("size").collect()
    sizes = sorted(r[1] for r in got)
    rest = sum(sizes[:-1])
    assert sizes[-1] == 400 * 216 and len(sizes) == 5 and sizes[3] <= rest / 4 + 100


def test_reruns_agree(edge_docs):
    runs = [sorted((r["doc_id"] or -1, r["size"], r["shard"], r["slot"]) for r in shards.shard(edge_docs.repartition(n), 3).collect()) for n in (2, 5)]
    assert runs[0] == runs[1]
