"""Distance-to-centroid scoring of message vectors.

Vectors are ``array<double>`` columns (ML vectors in the last section).  Model
tables (per-dimension mean and std, k centroids) are fitted by distributed
aggregates and stay frames; each is applied as one row, bounded by the vector
width and k and not by the data, that is joined to every vector.

Assignment compares each vector with the k centroids inside one expression
(no pairs), distance is ``sqrt(sum((x - c)^2))``; a vector is anomalous when its
distance exceeds the p95 distance of its cluster.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import KMEANS_K, SEED, THRESHOLD_PERCENTILE
from . import kmeans as KM
from . import sparse as SP
from .stats import quantile_by


def fit_standardizer(df: DataFrame, vec: str) -> DataFrame:
    """(i, mean, scale): per-dimension mean and population std (zero std → 1)."""
    std = F.stddev_pop(F.col("x").cast("double"))
    return (df.select(F.posexplode(vec).alias("i", "x")).groupBy("i")
            .agg(F.avg(F.col("x").cast("double")).alias("mean"), F.when(std > 0, std).otherwise(1.0).alias("scale")))


def _with_row(df: DataFrame, table: DataFrame, name: str, *cols: str) -> DataFrame:
    """``df`` with a whole model table as one sorted array."""
    one = table.agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    return df.crossJoin(F.broadcast(one))     # one row, model-sized


def standardized(df: DataFrame, vec: str, scaler: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out`` = (x - mean) / scale; the scaler's ``i`` runs from 0 without gaps."""
    z = F.zip_with(F.col(vec), F.col("_scaler"), lambda x, s: (x.cast("double") - s["mean"]) / s["scale"])
    return _with_row(df, scaler, "_scaler", "i", "mean", "scale").withColumn(out, z).drop("_scaler")


def fit_group_centroids(df: DataFrame, vec: str, group: str) -> DataFrame:
    """(cluster, centre): mean vector per group label (used as fixed centroids)."""
    return (df.select(F.col(group).alias("cluster"), F.posexplode(vec).alias("i", "x"))
              .groupBy("cluster", "i").agg(F.avg("x").alias("c"))
              .groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("i", "c"))).alias("cs"))
              .select("cluster", F.transform("cs", lambda e: e["c"]).alias("centre")))


def sq_distance(vec: Column, centre: Column) -> Column:
    return F.aggregate(F.zip_with(vec, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def assign_nearest(df: DataFrame, vec: str, centres: DataFrame) -> DataFrame:
    """``df`` with ``cluster`` and euclidean ``distance`` of the nearest centroid; ties → lowest id."""
    d2 = F.transform("_centres", lambda c: F.struct(sq_distance(F.col(vec), c["centre"]).alias("d2"), c["cluster"].alias("cluster")))
    best = F.array_min(d2)  # struct order: distance first, then id
    return (_with_row(df, centres, "_centres", "cluster", "centre").withColumn("_best", best)
            .withColumns({"cluster": F.col("_best.cluster"), "distance": F.sqrt(F.col("_best.d2"))}).drop("_centres", "_best"))


def distance_profile(scored: DataFrame, cluster: str = "cluster", dist: str = "distance",
                     q: float = THRESHOLD_PERCENTILE) -> DataFrame:
    """Per cluster: mean, population std, max, exact p95 threshold, count."""
    return scored.groupBy(cluster).agg(
        F.avg(dist).alias("mean_distance"), F.stddev_pop(dist).alias("std_distance"),
        F.max(dist).alias("max_distance"), F.count(F.lit(1)).alias("sample_count")).join(
        quantile_by(scored, [cluster], dist, q), cluster)


def flag_anomalies(scored: DataFrame, profile: DataFrame, cluster: str = "cluster",
                   dist: str = "distance") -> DataFrame:
    """distance > cluster threshold (strict).  A cluster without a profile has
    no threshold and is not flagged.  The profile has k rows and is broadcast: a
    shuffle by cluster would put most of the rows into a few tasks."""
    j = scored.join(F.broadcast(profile.select(cluster, "threshold")), cluster, "left")
    return j.withColumn("is_anomaly", F.coalesce(F.col(dist) > F.col("threshold"), F.lit(False)))


def cluster_stats(flagged: DataFrame, cluster: str = "cluster") -> DataFrame:
    return (flagged.groupBy(cluster)
            .agg(F.count(F.lit(1)).alias("count"),
                 F.sum(F.col("is_anomaly").cast("int")).cast("bigint").alias("anomaly_count"))
            .withColumn("anomaly_ratio", F.col("anomaly_count") / F.col("count")))


def cluster_stats_map(cluster: str = "cluster") -> Column:
    """Aggregate expression: map<string, struct<count, anomaly_count, anomaly_ratio>>."""
    return F.map_from_entries(F.collect_list(F.struct(
        F.col(cluster).cast("string"),
        F.struct("count", "anomaly_count", "anomaly_ratio"))))


def message_summary(flagged: DataFrame, dist: str = "distance") -> DataFrame:
    """One message-detector record: max/mean distance, anomaly count, total, any;
    none for an empty input."""
    return flagged.agg(F.max(dist).alias("max_distance"), F.avg(dist).alias("mean_distance"),
                       F.sum(F.col("is_anomaly").cast("int")).cast("bigint").alias("anomaly_count"),
                       F.count(F.lit(1)).alias("total_logs"),
                       F.coalesce(F.bool_or("is_anomaly"), F.lit(False)).alias("is_anomaly")).where("total_logs > 0")


# ---------------------------------------------------------------- Spark ML k-means

def kmeans_fit(df: DataFrame, features: str = "features", k: int = KMEANS_K, seed: int = SEED, max_iter: int = 20):
    from pyspark.ml.clustering import KMeans
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, predictionCol="cluster").fit(df.select(features))


def kmeans_assign(model, df: DataFrame) -> DataFrame:
    """``df`` (with ``features``, sparse) with the fitted model's ``cluster`` and the
    distance to its centre, from a broadcast join with the k-row centre table (a
    shuffle by cluster would put most vectors into a few tasks)."""
    centres = SP.centre_table(df.sparkSession, model.clusterCenters())
    j = model.transform(df).join(F.broadcast(centres), "cluster")
    return j.withColumn("distance", SP.distance(SP.entries(F.col("features")), F.col("centre"), F.col("norm"))).drop("centre", "norm")


def k_search(df: DataFrame, vec: str, default_k: int = KMEANS_K, seed: int = SEED,
             max_k: int = 20) -> list[tuple[int, float]]:
    """Euclidean silhouette of all vectors per candidate k, only when n > 5 * default_k; k in
    3 .. min(max_k, n//5) - 1, each the best of ten starts.  ``vec`` is an array or a
    struct of :func:`sparse.entries`."""
    data = df.select(vec).persist()
    try:
        n = data.count()
        ks = list(range(3, min(max_k, n // 5))) if n > default_k * 5 else []
        if not ks:
            return []
        scores = KM.silhouettes(data, vec, KM.fit_each(data, vec, ks, seed=seed))
        return [(k, scores[k]) for k in ks]
    finally:
        data.unpersist()


def best_k(scores: list[tuple[int, float]], default_k: int = KMEANS_K) -> int:
    best, best_score = default_k, -1.0
    for k, s in scores:
        if s > best_score:
            best, best_score = k, s
    return best
