"""Versioned model persistence as Parquet tables.

A model directory ``<root>/<detector>/v=<version>/`` holds small tables
(``meta``, ``vocab``, ``scaler``, ``trees``, ``coefficients``, ``centroids``,
``cluster_profile``).  Writing a new version never touches the running one;
readers take the highest version whose ``meta`` table, written last, is there
(no train/serve race).
"""
from __future__ import annotations

import json
import os

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def version_dir(root: str, detector: str, version: int) -> str:
    return os.path.join(root, detector, f"v={version}")


def save_tables(spark: SparkSession, root: str, detector: str, version: int,
                tables: dict[str, DataFrame], meta: dict) -> str:
    d = version_dir(root, detector, version)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(d, name))
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").parquet(os.path.join(d, "meta"))
    return d


def latest_version(spark: SparkSession, root: str, detector: str) -> int | None:
    path = os.path.join(root, detector)
    try:
        metas = spark.read.option("basePath", path).parquet(os.path.join(path, "v=*", "meta"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None   # no model yet
    return metas.agg({"v": "max"}).first()[0]


def load_tables(spark: SparkSession, root: str, detector: str, names: list[str],
                version: int | None = None) -> tuple[dict, dict[str, DataFrame]]:
    v = version if version is not None else latest_version(spark, root, detector)
    if v is None:
        raise FileNotFoundError(f"no model for {detector} under {root}")
    d = version_dir(root, detector, v)
    meta = json.loads(spark.read.parquet(os.path.join(d, "meta")).first()["meta"])
    return meta, {n: spark.read.parquet(os.path.join(d, n)) for n in names}


def forest_to_frame(spark: SparkSession, model: dict) -> DataFrame:
    rows = []
    for tid, t in model["trees"].items():
        for i in range(len(t["feature"])):
            rows.append((int(tid), i, int(t["feature"][i]), float(t["split"][i]), int(t["left"][i]),
                         int(t["right"][i]), int(t["size"][i]), int(t["depth"][i])))
    return spark.createDataFrame(rows, "tree_id int, node int, feature int, split double, left int, right int, size long, depth int")


def forest_from_frame(df: DataFrame, psi: int) -> dict:
    pdf = df.toPandas()
    trees = {}
    for tid, g in pdf.groupby("tree_id"):
        g = g.sort_values("node")
        trees[int(tid)] = {c: g[c].to_numpy() for c in ["feature", "split", "left", "right", "size", "depth"]}
    return {"psi": psi, "trees": trees}


def matrix_to_frame(spark: SparkSession, w: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(w)], "row int, w array<double>")


def matrix_from_frame(df: DataFrame) -> np.ndarray:
    rows = sorted(df.collect(), key=lambda r: r["row"])
    return np.array([r["w"] for r in rows], dtype=float)
