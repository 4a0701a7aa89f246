"""Helpers shared by the operators of this subpackage.

Operators read their input by position-safe column picks, so extra columns
with clashing names (also names that differ only in case) never matter, and
they cut lineage with Parquet tables in the shared folder that the session
names in ``spark.checkpoint.dir``.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: White space of the contracts: space and the controls 9 to 13.
WS = "[\\x20\\x09-\\x0D]"
#: Stands in for a null id inside operators: sorts after every real id.
NO_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Select ``new=old`` columns; ``old`` must match exactly, first one wins."""
    at = {new: df.columns.index(old) for new, old in cols.items()}
    plain = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"__{i}").alias(new) for new, i in at.items()])


def id_or_last(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(NO_ID)).cast("long")


def id_back(c: Column | str) -> Column:
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(NO_ID))


#: Rows of an Arrow batch, where the session keeps Spark's default of 10,000:
#: whole texts are far larger than the rows that default is meant for.
BATCH_ROWS = "500"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: What operators keep in a worker between batches: name → function that drops it.
WORKER_CACHES: dict = {}


def keep_only(name: str) -> None:
    """Called in a worker when an operator starts on a task: workers are reused,
    so what other operators kept there goes first."""
    for other, drop in WORKER_CACHES.items():
        if other != name:
            drop()


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package available to the workers."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    return df.mapInArrow(fn, schema)


def stored_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    result no longer depends on executors or on a second run of its plan."""
    spark = df.sparkSession
    path = stored_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstore(df: DataFrame) -> None:
    """Delete the files of a frame made by :func:`stored`, once replaced."""
    spark = df.sparkSession
    for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
