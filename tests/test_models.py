import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from loglens.operators import clustering as CL
from loglens.operators import embedding as EM
from loglens.operators import features as FT
from loglens.operators import forecast as FC
from loglens.operators import forest as FO
from loglens.operators import kmeans as KM
from loglens.operators import sparse as SP
from loglens.operators.sequences import sequences


def test_forest_outlier_lowest(spark):
    rng = np.random.default_rng(0)
    pts = [(i, [float(v) for v in rng.normal(0, 1, 3)]) for i in range(400)] + [(999, [8.0, 8.0, 8.0])]
    df = spark.createDataFrame(pts, "k long, x array<double>")
    model = FO.fit_forest(df, "k", "x", n_trees=50)
    s = FO.score_forest(df, "x", model).toPandas()
    assert s.anomaly_score.between(-1, 0).all()
    assert s.sort_values("anomaly_score").iloc[0]["k"] == 999


def test_sequence_counts(spark):
    rows = [("s", i, [float(i)]) for i in range(21)] + [("t", i, [1.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "series_key string, minute int, vec array<double>")
    out = sequences(df).toPandas()
    assert (out.series_key == "s").sum() == 11 and (out.series_key == "t").sum() == 0
    first = out[out.series_key == "s"].sort_values("minute").iloc[0]
    assert [v[0] for v in first.x] == list(range(10)) and first.y[0] == 10.0


def test_ridge_equals_the_normal_equations(spark):
    rng = np.random.default_rng(1)
    x, noise = rng.normal(size=(300, 4, 3)), rng.normal(size=(300, 3)) * 0.1
    flat = np.hstack([x.reshape(300, -1), np.ones((300, 1))])
    y = flat @ rng.normal(size=(13, 3)) + noise
    df = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y))], "i int, x array<array<double>>, y array<double>").repartition(5)
    want = np.linalg.solve(flat.T @ flat + 1e-3 * np.eye(13), flat.T @ y)
    w = FC.fit_ridge(df)
    assert np.allclose(w, want)
    got = FC.forecast_errors(df, w).orderBy("i").toPandas()
    assert np.allclose(got.error, np.abs(flat @ want - y).mean(axis=1)) and np.allclose(got.sq_error, ((flat @ want - y) ** 2).mean(axis=1))


def test_conjugate_gradients_equal_the_plain_solve(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5, 4)) * np.array([1.0, 20.0, 0.1, 1.0])     # columns of unlike scales
    flat = np.hstack([x.reshape(400, -1), np.ones((400, 1))])
    y = flat @ rng.normal(size=(21, 4)) + rng.normal(size=(400, 4))
    y[:, 3] = 0.0                                                          # a target without anything to fit
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "x array<array<double>>, y array<double>").repartition(5).persist()
    want = np.linalg.solve(flat.T @ flat + 1e-3 * np.eye(21), flat.T @ y)
    got = FC.fit_gradients(df)
    assert np.allclose(got, want, rtol=1e-6, atol=1e-8) and not got[:, 3].any()
    with pytest.raises(RuntimeError):
        FC.fit_gradients(df, max_passes=2)
    for fit in FC.SOLVERS.values():
        with pytest.raises(ValueError):
            fit(df.limit(0))


def test_vocabulary_table_and_vectors(spark):
    cells = spark.createDataFrame([("a", "x", 2), ("a", "z", 1), ("b", "y", 5), ("c", "new", 9), ("c", "x", 0), ("d", "new", 1), ("d", None, 1)],
                                  "bucket string, feature string, n long")
    known = cells.where("feature <> 'new'")
    vocab = FT.vocabulary(known)
    at = {r.feature: r.i for r in vocab.collect()}
    assert sorted(at) == ["x", "y", "z"] and sorted(at.values()) == [0, 1, 2]
    assert at == {r.feature: r.i for r in FT.vocabulary(known.repartition(7)).collect()}
    got = {r.bucket: r.vec for r in FT.dense_vectors(cells, vocab, ["bucket"]).collect()}
    want = {"a": {"x": 2.0, "z": 1.0}, "b": {"y": 5.0}, "c": {"x": 0.0}}
    assert got == {b: [v.get(f, 0.0) for f in sorted(at, key=at.get)] for b, v in want.items()}
    many = spark.range(5000).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("feature"))
    assert [r.i for r in FT.vocabulary(many.unionAll(many)).orderBy("i").collect()] == list(range(5000))
    assert FT.vocabulary(many.limit(0)).isEmpty()
    zeros = spark.createDataFrame([([],), (None,), ([(3, 1.5)],)], "cells array<struct<i: int, x: double>>")
    assert [r.v for r in zeros.select(FT.widened(F.col("cells"), 4).alias("v")).collect()] == [[0.0] * 4, [0.0] * 4, [0.0, 0.0, 0.0, 1.5]]


def test_standardizer_and_nearest_centroid(spark):
    rng = np.random.default_rng(3)
    x = np.hstack([rng.normal(3, 2, (50, 3)), np.full((50, 1), 7.0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<float>")
    x = x.astype("float32").astype(float)
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 1e-12, x.std(axis=0), 1.0)
    out = CL.standardized(df.withColumnRenamed("i", "id"), "v", CL.fit_standardizer(df, "v"), "z").orderBy("id").collect()
    assert np.allclose([r.z for r in out], z)
    cents = CL.fit_group_centroids(spark.createDataFrame([(i % 3, r.z) for i, r in enumerate(out)], "g int, z array<double>"), "z", "g")
    c = np.array([z[g::3].mean(axis=0) for g in range(3)])
    d = np.sqrt(((z[:, None] - c[None]) ** 2).sum(axis=2))
    got = CL.assign_nearest(spark.createDataFrame([(i, r.z) for i, r in enumerate(out)], "id int, z array<double>"), "z", cents).orderBy("id").collect()
    assert [r.cluster for r in got] == list(d.argmin(axis=1)) and np.allclose([r.distance for r in got], d.min(axis=1))


def test_sparse_vectors_are_never_widened(spark):
    texts = [(i, t) for i, t in enumerate(["disk full on host one", "disk slow", "login failed for user", "login ok", "", "disk full disk full"])]
    model, vecs = EM.tfidf_vectors(spark.createDataFrame(texts, "id int, text string"), "text", num_features=64)
    assert vecs.columns == ["id", "text", "features"]
    rows = vecs.orderBy("id").collect()
    x = np.array([r.features.toArray() for r in rows])
    one = vecs.select("id", SP.entries(F.col("features")).alias("v")).orderBy("id")
    got = one.select("id", "v", SP.n_terms(F.col("v")).alias("n"), SP.square(F.col("v")).alias("s")).collect()
    assert [r.n for r in got] == [(v != 0).sum() for v in x] and np.allclose([r.s for r in got], (x * x).sum(axis=1))
    assert all(r.v.size == 64 and len(r.v.idx) <= 5 for r in got)
    c = np.random.default_rng(0).normal(size=(2, 64))
    dist = one.join(SP.centre_table(spark, c), F.lit(True), "cross").withColumn("d", SP.distance(F.col("v"), F.col("centre"), F.col("norm")))
    assert np.allclose([r.d for r in dist.orderBy("cluster", "id").collect()], [np.linalg.norm(v - k) for k in c for v in x])
    fitted = CL.kmeans_fit(vecs, k=2)
    own = np.array(fitted.clusterCenters())
    out = CL.kmeans_assign(fitted, vecs).orderBy("id").collect()
    assert np.allclose([r.distance for r in out], [np.linalg.norm(v - own[r.cluster]) for v, r in zip(x, out)], atol=1e-7)
    dense = spark.createDataFrame([([0.0, 3.0, 4.0],)], "a array<double>").select(SP.entries(array_to_vector("a")).alias("v"))
    assert tuple(dense.select("v.size", "v.idx", SP.square(F.col("v"))).first()) == (3, [0, 1, 2], 25.0)


def test_kmeans_over_sparse_vectors_equals_arrays(spark):
    rng = np.random.default_rng(4)
    x = np.where(rng.random((90, 12)) < 0.3, rng.normal(size=(90, 12)), 0.0) + 5 * np.eye(12)[np.arange(90) % 3]
    arrays = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>")
    sparse = arrays.select(SP.entries(array_to_vector("v")).alias("v"))
    a, b = (KM.fit(df, "v", 3, starts=4) for df in (arrays, sparse))
    assert abs(a.inertia - b.inertia) < 1e-6
    sa, sb = (KM.silhouettes(df, "v", {3: a}, rows=90) for df in (arrays, sparse))
    assert abs(sa[3] - sb[3]) < 1e-9


def test_user_encoder_in_batches(spark):
    def load():
        def encode(texts):
            assert len(texts) <= 4
            return np.array([[len(t), t.count("a")] for t in texts], dtype=float)
        return encode

    rows = [(i, "a" * (i % 5) + "b") for i in range(30)] + [(30, None)]
    out = EM.encode_with(spark.createDataFrame(rows, "id int, text string"), "text", load, 2, batch=4).collect()
    assert {r.id: r.vec for r in out} == {i: [float(len(t or "")), float((t or "").count("a"))] for i, t in rows}


def test_vectors_are_not_shuffled_by_cluster(spark):
    rows = [(i, [float(i % 3), 1.0 + i % 2, 0.5 * i]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, a array<double>").select("i", array_to_vector("a").alias("features"))
    scored = CL.kmeans_assign(CL.kmeans_fit(df, k=3), df)
    flagged = CL.flag_anomalies(scored, spark.createDataFrame([(0, 1.0), (1, 2.0)], "cluster int, threshold double"))
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan
    limits = {0: 1.0, 1: 2.0}
    got = flagged.collect()
    assert len(got) == 60 and all(r.is_anomaly == (r.distance > limits.get(r.cluster, float("inf"))) for r in got)
