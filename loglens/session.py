"""Session helpers.

Library code never hard-codes cluster settings: it reads what the session
carries.  ``get_spark`` is a convenience for tests, the bench and scripts.
"""
from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package.  AQE re-plans joins at
# runtime (size-checked broadcast, skew splitting, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "loglens", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when it is unset (unit tests) do we pick a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="loglens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as files of the shared checkpoint folder: a lost executor costs
    nothing, and plans built on it start there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "loglens", name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared checkpoint folder: as safe as
    a checkpoint, but compressed, and each use reads only its columns."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context.

    A zip of the package goes to the shared checkpoint folder and from there to
    the executors (``addPyFile``); nothing is left in a machine's own folders."""
    sc = spark.sparkContext
    if getattr(sc, "_loglens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/loglens-{sc.applicationId}.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    sc._loglens_shipped = True
