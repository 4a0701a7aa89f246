"""Corpus pipeline over ``documents``: quality, line dedup, near-dedup, mix, tokens.

Each stage works on all rows its predecessor kept, written as Parquet in the
shared folder and read again.  All stages but the last return the columns of
their input; the last returns one row per remaining document copy with its
token ids.

* ``quality``      documents the classifier predicts as label 0 go;
* ``line_dedup``   repeated lines go from all documents but the last that holds
  them; ``n_chars``, if there, is brought up to date, a null text stays null;
* ``near_dedup``   one document of each group stays (five words, 0.8);
* ``mix``          rows are repeated or left out as the target weights ask;
* ``tokens``       ids, their count and digests of ids and decoded bytes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import bpe, linededup, minhash, mixing, quality
from loglens.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    names = docs.columns
    out = quality.scored(docs, model)
    plain = out.toDF(*[f"__{i}" for i in range(len(names))], "score")
    return plain.filter(quality.predicted("score")).drop("score").toDF(*names)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.apply(linededup.build(docs), docs)
    if "n_chars" not in docs.columns:
        return out
    names = docs.columns
    plain = out.toDF(*[f"__{i}" for i in range(len(names))])
    at, text = f"__{names.index('n_chars')}", f"__{names.index('text')}"
    size = F.coalesce(F.char_length(text).cast(plain.schema[at].dataType), F.col(at))
    return plain.withColumn(at, size).toDF(*names)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs, width=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, mixing.WEIGHTS, seed=9)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, keep_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("mix", mix_stage),
    ("tokens", token_stage),
]

#: Latent vectors, minima and merges can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
