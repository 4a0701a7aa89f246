import numpy as np

from loglens.llm import quality as Q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/labels.parquet").join(Q.op6_knn_quality(spark, sf), "doc_id").filter("held_out").toPandas()
    assert len(d) > 100 and (d.quality == d.predicted).mean() > 0.97
    assert d.score.between(0, 1).all()


def test_blocked_votes_equal_brute_force():
    rng = np.random.default_rng(3)
    counts, labels = rng.random((90, Q.BUCKETS)) * (rng.random((90, Q.BUCKETS)) < .05), rng.integers(0, 2, 90)
    m = Q.Model(counts, labels, 0.7)
    docs = rng.random((1100, Q.BUCKETS)) * (rng.random((1100, Q.BUCKETS)) < .05)
    got = m.scores(docs)
    v = docs * m.idf
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32) @ m.space
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for i in range(0, 1100, 97):
        cos = m.rows @ v[i]
        near = np.argsort(-cos, kind="stable")[:Q.NEIGHBOURS]
        w = np.maximum(cos[near], 0) ** Q.SHARPNESS * m.weight[near]
        assert abs(got[i] - (w * labels[near]).sum() / w.sum()) < 1e-3


def test_nearest_with_ties():
    cos = np.array([[.5, .9, .5, .5, .1, .9]])
    assert sorted(Q.Model._nearest(cos, 4)[0].tolist()) == [0, 1, 2, 5]


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)] + [(1, 1, 0), (None, 1, 0), (2, None, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit(edge_docs, labels)
    out = Q.scored(edge_docs, model)
    assert out.columns == [*edge_docs.columns, "score"]
    rows = out.collect()
    assert len(rows) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in rows if not (r[1] or "").split())
    assert Q.scored(no_docs, model).collect() == []
    none = Q.fit(edge_docs, labels.limit(0))
    assert none is None and {r["score"] for r in Q.scored(edge_docs, none).collect()} == {0.0, 0.5}
    one = Q.fit(edge_docs, labels.filter("quality = 1"))
    assert {r["score"] for r in Q.scored(edge_docs, one).collect()} == {0.0, 1.0}
