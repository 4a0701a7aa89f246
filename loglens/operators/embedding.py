"""Message vectors for the distance detector.

Default encoder: ``RegexTokenizer → HashingTF → IDF → Normalizer`` (all
built-in, distributed; IDF is one aggregate pass).  Whole texts are encoded;
nothing is truncated.  The vectors stay sparse (``operators.sparse``).  A user
encoder can be plugged in through :func:`encode_with` (``mapInPandas``; the model
is loaded once per task and applied in batches); its output is ``array<double>``.
"""
from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def tfidf_vectors(df: DataFrame, text: str, num_features: int = 1 << 12, min_doc_freq: int = 1):
    """(fitted pipeline model, frame with ``features``: sparse, L2-normalised)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern="\\W+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_idf", minDocFreq=min_doc_freq),
        Normalizer(inputCol="_idf", outputCol="features", p=2.0),
    ])
    model = pipe.fit(df)
    return model, encoded(model, df)


def encoded(model, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("_tok", "_tf", "_idf")


def encode_with(df: DataFrame, text: str, load_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
                dim: int, batch: int = 32) -> DataFrame:
    """Apply a user encoder (e.g. a sentence model) in batches of ``batch`` texts."""
    schema = T.StructType(df.schema.fields + [T.StructField("vec", T.ArrayType(T.DoubleType()))])

    def run(it):
        enc = load_encoder()
        for pdf in it:
            texts = pdf[text].fillna("").tolist()
            vecs = [np.asarray(enc(texts[i:i + batch]), dtype=float) for i in range(0, len(texts), batch)]
            arr = np.vstack(vecs) if vecs else np.zeros((0, dim))
            yield pdf.assign(vec=list(arr))

    return df.mapInPandas(run, schema)
