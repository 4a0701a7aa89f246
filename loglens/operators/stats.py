"""Small fitted statistics (scaler parameters) and their application.

Fitting is a single distributed aggregate whose result has one value per
feature (bounded by the feature vocabulary, not by the data); applying is a
column expression or an equi-join on the feature name.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def zscore_fit(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.avg(col).alias("m"), F.stddev_pop(col).alias("s")).first()
    return (r["m"] or 0.0), (r["s"] or 0.0)


def zscore(col: Column, mean: float, std: float) -> Column:
    """Standardise with population std; a zero std divides by 1."""
    return (col - F.lit(mean)) / F.lit(std if std else 1.0)


def quantile_by(df: DataFrame, keys: list[str], col: str, q: float, out: str = "threshold", bins: int = 4096) -> DataFrame:
    """Exact ``q`` quantile (linear interpolation, as ``percentile``) of ``col``
    for each group; groups of nulls only have no row.

    Counts in ``bins`` equal bins between a group's least and greatest value
    (a partial aggregate) show in which bin each of the two ranks lies; only
    values of those bins are ordered, equal ones as one row.  No buffer ever
    holds a group's values."""
    v = df.select(*keys, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    pos = F.lit(q) * (F.col("_n") - 1)
    rng = v.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    rng = rng.select(*keys, "_lo", "_hi", pos.alias("_pos"), F.floor(pos).alias("_k1"), F.ceil(pos).alias("_k2"))
    share = (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    bin_ = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(share * bins), F.lit(bins - 1).cast("long"))).otherwise(F.lit(0).cast("long"))
    on = lambda a, b, cols: a.join(b, cols) if cols else a.join(F.broadcast(b))  # noqa: E731  (no keys: b is one row)
    binned = on(v, rng, keys).withColumn("_b", bin_)
    hist = binned.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_b"))
    hit = on(hist.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_c")), rng, keys).where(
        F.col("_k1").between(F.col("_before"), F.col("_upto") - 1) | F.col("_k2").between(F.col("_before"), F.col("_upto") - 1))
    few = binned.join(hit.select(*keys, "_b", "_before"), [*keys, "_b"]).groupBy(*keys, "_b", "_before", "_x").agg(F.count(F.lit(1)).alias("_c"))
    last = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_b").orderBy("_x"))
    ranked = on(few.withColumn("_last", last).withColumn("_from", F.col("_last") - F.col("_c")), rng, keys)
    at = lambda k: F.max(F.when(F.col(k).between(F.col("_from"), F.col("_last") - 1), F.col("_x")))
    g = ranked.groupBy(*keys).agg(at("_k1").alias("_a"), at("_k2").alias("_z"), F.max("_pos").alias("_pos"), F.max("_k1").alias("_k1"))
    return g.select(*keys, (F.col("_a") + (F.col("_pos") - F.col("_k1")) * (F.col("_z") - F.col("_a"))).alias(out))
