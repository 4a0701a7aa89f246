"""Sparse message vectors: indices and values, never widened.

Encoders leave Spark ML vectors (column ``features``); :func:`entries` opens one
as ``struct<size, idx, val>`` with built-in functions.  Distances to centres come
from the stored norms and the entries alone, so a row costs its own terms and
not the width of the vector space.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CENTRES = "cluster int, centre array<double>, norm double"
#: Rows that a worker widens at a time.
CHUNK = 512


def entries(features: Column) -> Column:
    """struct(size, idx, val) of an ML vector; a null vector gives a null struct,
    a dense one lists all its places."""
    u = F.unwrap_udt(features)
    dense = u["type"] == 1
    every = F.when(F.size(u["values"]) > 0, F.sequence(F.lit(0), F.size(u["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(features.isNotNull(), F.struct(
        F.when(dense, F.size(u["values"])).otherwise(u["size"]).alias("size"),
        F.when(dense, every).otherwise(u["indices"]).alias("idx"), u["values"].alias("val")))


def n_terms(vec: Column) -> Column:
    """Places that aren't 0."""
    return F.size(F.filter(vec["val"], lambda x: x != 0))


def dot(vec: Column, centre: Column) -> Column:
    """Inner product with a full array, over the entries of ``vec`` only."""
    return F.aggregate(F.zip_with(vec["idx"], vec["val"], lambda i, v: v * F.get(centre, i)), F.lit(0.0), lambda s, v: s + v)


def square(vec: Column) -> Column:
    return F.aggregate(vec["val"], F.lit(0.0), lambda s, v: s + v * v)


def distance(vec: Column, centre: Column, norm: Column) -> Column:
    """Euclidean distance to ``centre``, whose squared length is ``norm``."""
    return F.sqrt(F.greatest(square(vec) + norm - 2 * dot(vec, centre), F.lit(0.0)))


def centre_table(spark: SparkSession, centres) -> DataFrame:
    """One row a centre (model-sized)."""
    rows = [(i, [float(x) for x in c], float(np.dot(c, c))) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, CENTRES)


def widened(column: pd.Series) -> np.ndarray:
    """Matrix of a few sparse vectors, in a worker."""
    out = np.zeros((len(column), int(column.iloc[0]["size"]) if len(column) else 0))
    for r, v in enumerate(column):
        out[r, np.asarray(v["idx"], dtype=int)] = v["val"]
    return out
