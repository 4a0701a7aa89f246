import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from loglens import models as MD
from loglens.operators import forest as FO
from loglens.operators.features import window_features
from loglens.streaming.streams import window_count_stream


def test_forest_roundtrip(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, [float(v) for v in rng.normal(0, 1, 2)]) for i in range(100)], "k long, x array<double>")
    model = FO.fit_forest(df, "k", "x", n_trees=10)
    root = tempfile.mkdtemp(prefix="loglens-models-")
    MD.save_tables(spark, root, "isolation_forest", 1, {"trees": MD.forest_to_frame(spark, model)}, {"psi": model["psi"]})
    MD.save_tables(spark, root, "isolation_forest", 2, {"trees": MD.forest_to_frame(spark, model)}, {"psi": model["psi"]})
    assert MD.latest_version(spark, root, "isolation_forest") == 2
    meta, t = MD.load_tables(spark, root, "isolation_forest", ["trees"])
    again = MD.forest_from_frame(t["trees"], meta["psi"])
    a = FO.score_forest(df, "x", model).orderBy("k").toPandas().anomaly_score.to_numpy()
    b = FO.score_forest(df, "x", again).orderBy("k").toPandas().anomaly_score.to_numpy()
    assert np.allclose(a, b)


def test_window_stream_equals_batch(spark):
    rows = [("2024-01-01 00:00:07", "ERROR", "auth", "Login failed"), ("2024-01-01 00:03:00", "INFO", "web", "ok"),
            ("2024-01-01 00:04:59", "ERROR", "auth", "timeout"), ("2024-01-01 00:20:00", "WARN", "db", "slow")]
    df = spark.createDataFrame(rows, "t string, log_level string, component string, message string") \
              .select(F.col("t").cast("timestamp_ntz").alias("event_ts"), "log_level", "component", "message")
    d = tempfile.mkdtemp(prefix="loglens-win-")
    df.write.parquet(os.path.join(d, "src"))
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(d, "src"))
    q = (window_count_stream(stream, "5 minutes", "5 minutes", "0 seconds").writeStream.format("memory")
         .queryName("wins").outputMode("complete").option("checkpointLocation", os.path.join(d, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql("select window_start, feature, n from wins").collect())
    exp = sorted(tuple(r) for r in window_features(df, "5 minutes").select("bucket", "feature", "n").collect())
    assert got == exp
