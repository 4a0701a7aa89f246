import hashlib

import corpus_pipeline as P
from loglens.llm import mixing
from loglens.llm.common import stored, table
from test_linededup import brute as line_brute
from test_minhash import brute as near_brute

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in P.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        out[name] = (before, docs)
        if name != P.STAGES[-1][0]:
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
    rows = lambda d: [(r["doc_id"], r["text"]) for r in d.collect()]

    before, after = out["quality"]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = {i for i, _ in rows(after)}
    good = [i for i, _ in rows(before) if labels.get(i) == 1]
    assert sum(i in kept for i in good) / len(good) > 0.98

    before, after = out["line_dedup"]
    want = {r[0]: r[3] for r in line_brute(rows(before))}
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows(after)} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = out["near_dedup"]
    assert sorted(i for i, _ in rows(after)) == [i for i, _, c in near_brute(rows(before), 5, 80) if i == c]

    before, after = out["mix"]
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(before, mixing.WEIGHTS, seed=9).collect() if r["size"]}
    got = {}
    for i, _ in rows(after):
        got[i] = got.get(i, 0) + 1
    assert got == {i: n for i, n in taken.items() if n}

    before, after = out["tokens"]
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in after.collect()) == sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows(before))


def test_edge_rows(spark, edge_docs, no_docs):
    names = ["doc_id", "text", "lang", "source", "n_chars", "extra", "doc", "h", "n", "spans"]   # a table can't hold names that differ in case only
    for docs in (edge_docs.toDF(*names), no_docs.toDF(*names)):
        for name, stage in P.STAGES:
            docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def test_order_of_stages():
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "tokens"]
