"""Quality classifier: similarity-weighted votes of labelled neighbours in a
latent-semantic space.

Fit (on a bounded sample of labelled rows, SAMPLE_PER_CLASS a class):
* a text's terms are its words' shapes, its common words (hashed), and how
  often words follow themselves; counts are damped and weighted by inverse
  document frequency;
* the leading DIMS right singular vectors of the sample's matrix span the
  latent space; sample rows, projected and scaled to length 1, are the
  labelled vectors (SAMPLE_PER_CLASS * 2 * DIMS floats at most, broadcast).

Score (every whole text): the text's vector is multiplied with all labelled
vectors in blocks (exact cosine, no index); the NEIGHBOURS nearest vote with
weight max(cosine, 0) ** SHARPNESS, and each class's votes are divided by the
class's share of the sample times its share of the labels, so the balanced
sample doesn't move the odds.

Defined results: a text without words (null, empty, blank) scores 0; without
labels of both classes every other text scores the label that there is, or
0.5 without any; neighbours at equal cosine are taken in sample order, which
is an order by hash of id; repeated label rows count once (the lowest label);
labels of null are no labels.  Scores depend on the text alone.
"""
from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORKER_CACHES, keep_only, map_arrow, pick, table

#: The fit's bound: labelled rows of each class, lowest hash of id first.
SAMPLE_PER_CLASS = 1500
BUCKETS = 1024            # hashed terms
DIMS = 48
NEIGHBOURS = 15
SHARPNESS = 4
BLOCK = 512               # documents multiplied with the labelled vectors at once
THRESHOLD = 0.3
RUN_WEIGHT = 20.0         # of the term for words that follow themselves
RUN_PRIOR = 12            # words added to a text, so that a short one is not odd for one run
CACHE_WORDS = 100_000

#: byte → kind: a lower case, A upper case, 0 digit; other ASCII is itself,
#: bytes of other characters are lower case.
_SHAPE = bytes(ord("a") if 97 <= b <= 122 or b > 127 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    """'Word,' → b'Aa,'; b'###' → b'#'."""
    return _RUNS.sub(rb"\1", word.translate(_SHAPE))


def hashed(kind: bytes, term: bytes) -> int:
    from zlib import crc32

    return crc32(kind + term) % BUCKETS


class Terms:
    """Term counts of texts; keeps the terms of common words, up to CACHE_WORDS."""

    def __init__(self):
        self.of: dict[bytes, tuple[int, int]] = {}

    def word(self, w: bytes) -> tuple[int, int]:
        """(shape term, word term); words of up to 4 bytes are terms themselves,
        longer ones by their first and last two bytes."""
        low = w.lower()
        return hashed(b"s", shape(w)), hashed(b"w", low if len(low) <= 4 else low[:2] + b"-" + low[-2:])

    def counts(self, text: bytes | None) -> np.ndarray | None:
        """Damped counts by bucket, None without words."""
        words = (text or b"").split()
        if not words:
            return None
        n = len(words)
        out = np.zeros(BUCKETS)
        for w, c in Counter(words).items():
            terms = self.of.get(w)
            if terms is None:
                if len(self.of) >= CACHE_WORDS:
                    self.of.clear()
                terms = self.of[w] = self.word(w)
            out[terms[0]] += c
            out[terms[1]] += c
        out *= 1000.0 / n                       # a rate a thousand words: length is no feature
        runs = sum(map(bytes.__eq__, words, words[1:]))
        out[hashed(b"r", b"")] += 1000.0 * RUN_WEIGHT * runs / (n + RUN_PRIOR)
        return np.log1p(out)


@lru_cache(maxsize=1)
def terms() -> Terms:
    keep_only("quality")
    return Terms()


WORKER_CACHES["quality"] = terms.cache_clear


class Model:
    """Latent space and labelled vectors."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, share: float):
        """counts: sample rows; share: label 1 among all labels."""
        self.idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
        x = self._unit(counts * self.idf)
        _, vectors = np.linalg.eigh(x.T @ x)
        self.space = np.ascontiguousarray(vectors[:, ::-1][:, :DIMS]).astype(np.float32)
        self.rows = self._unit(x.astype(np.float32) @ self.space)
        own = labels.mean() if len(labels) else 0.5
        odds = np.array([(1 - share) / max(1 - own, 1e-9), share / max(own, 1e-9)])
        self.weight, self.labels = odds[labels.astype(int)].astype(np.float32), labels.astype(np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12).astype(x.dtype)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Scores of documents (rows of damped counts), block by block."""
        out = np.empty(len(counts))
        for i in range(0, len(counts), BLOCK):
            v = self._unit(self._unit(counts[i:i + BLOCK] * self.idf).astype(np.float32) @ self.space)
            cos = v @ self.rows.T
            k = min(NEIGHBOURS, cos.shape[1])
            near = np.argsort(-cos, axis=1, kind="stable")[:, :k] if cos.shape[1] <= 4 * k else self._nearest(cos, k)
            votes = np.maximum(np.take_along_axis(cos, near, 1), 0) ** SHARPNESS * self.weight[near]
            total = votes.sum(axis=1)
            out[i:i + BLOCK] = np.where(total > 0, (votes * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-30), self.labels.mean())
        return np.clip(out, 0.0, 1.0)

    @staticmethod
    def _nearest(cos: np.ndarray, k: int) -> np.ndarray:
        """The k largest of each row, ties in column order."""
        least = -np.partition(-cos, k - 1, axis=1)[:, k - 1:k]
        rank = np.where(cos > least, 2, np.where(cos == least, 1, 0)) * cos.shape[1] - np.arange(cos.shape[1])
        return np.argpartition(-rank, k - 1, axis=1)[:, :k]


def held_out(id_: Column) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Model from the labelled documents outside the held-out fifth."""
    lab = pick(labels, id=id_col, y=label_col).filter("y IS NOT NULL AND id IS NOT NULL").filter(~held_out(F.col("id")))
    lab = lab.groupBy("id").agg(F.min("y").cast("int").alias("y"))
    by_class = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect() if r["y"] in (0, 1)}
    total = sum(by_class.values())
    if not total:
        return None
    # one sample row for each id with a document; SAMPLE_PER_CLASS of the lowest hashes
    known = lab.join(pick(docs, id=id_col).distinct(), "id", "left_semi").withColumn("h", F.xxhash64("id"))
    parts = [known.filter(F.col("y") == y).orderBy("h", "id").limit(SAMPLE_PER_CLASS) for y in sorted(by_class)]
    sample = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    texts = pick(docs, id=id_col, text=text_col).join(F.broadcast(sample), "id")
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("x", T.BinaryType())])

    def run(batches):
        t = terms()
        for b in batches:
            rows = [t.counts(x) for x in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([None if x is None else x.astype("<f4").tobytes() for x in rows], pa.binary())], schema.names)

    counted = map_arrow(texts.select("h", "y", "text"), run, schema).filter("x IS NOT NULL")
    rows = sorted({(r["h"], r["y"], bytes(r["x"])) for r in counted.dropDuplicates(["h"]).collect()})   # 2 * SAMPLE_PER_CLASS * BUCKETS floats
    if not rows:
        return None
    x = np.frombuffer(b"".join(r[2] for r in rows), "<f4").reshape(-1, BUCKETS).astype(np.float64)
    return Model(x, np.array([r[1] for r in rows]), by_class.get(1, 0) / total)


def scored(df: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """The rows of ``df`` (columns ``keep``, all by default) with ``score_col``."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    at, names = df.columns.index(text_col), df.columns if keep is None else keep
    plain = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    cols = [df.columns.index(c) for c in names]
    read = [*cols, *([] if at in cols else [at])]
    plain = plain.select(*[f"__{i}" for i in read])
    schema = T.StructType([*[plain.schema[f"__{i}"] for i in cols], T.StructField("score", T.DoubleType())])

    def run(batches):
        t, m = terms(), sent.value
        for b in batches:
            texts = b.column(read.index(at)).cast(pa.binary())
            out = []
            for i in range(0, len(texts), BLOCK):
                x = [t.counts(v) for v in texts[i:i + BLOCK].to_pylist()]
                some = [v for v in x if v is not None]
                s = iter(m.scores(np.array(some)) if some and m else [0.5] * len(some))
                out += [0.0 if v is None else float(next(s)) for v in x]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(cols)], pa.array(out, pa.float64())], schema.names)

    return map_arrow(plain, run, schema).toDF(*names, score_col)


def predicted(score: Column | str) -> Column:
    return (F.col(score) if isinstance(score, str) else score) >= THRESHOLD


def op6_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(pick(docs, doc_id="doc_id", text="text"), model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted("score").cast("int").alias("predicted"))


QUERIES = {"op6_knn_quality": op6_knn_quality}
SQL: dict[str, str] = {}
