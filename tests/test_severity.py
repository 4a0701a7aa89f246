from loglens.functions.severity import severity

SCHEMA = ("detector_type string, anomaly_score double, mean_error double, threshold double, "
          "anomaly_count bigint, total_sequences bigint, total_logs bigint")


def grade(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return [r[0] for r in df.select(severity()).collect()]


def test_forest(spark):
    rows = [("isolation_forest", s, None, None, None, None, None) for s in [-0.71, -0.70, -0.51, -0.50, -0.31, -0.30, None]]
    assert grade(spark, rows) == ["critical", "high", "high", "medium", "medium", "low", "low"]


def test_lstm(spark):
    rows = [("lstm", None, e, 1.0, 0, 20, None) for e in [2.01, 2.0, 1.5, 1.2]]
    rows += [("lstm", None, 9.0, None, a, 20, None) for a in [11, 10, 7, 3, 2]]
    rows += [("lstm", None, None, None, 1, 0, None)]
    assert grade(spark, rows) == ["critical", "high", "medium", "low",
                                  "critical", "high", "high", "medium", "low", "critical"]


def test_bert_and_other(spark):
    rows = [("bert", None, None, None, a, None, 10) for a in [6, 5, 3, 1]] + [("other", None, None, None, None, None, None)]
    assert grade(spark, rows) == ["critical", "high", "medium", "low", "medium"]
