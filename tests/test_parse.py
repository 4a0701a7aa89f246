from pyspark.sql import functions as F

from loglens.functions.parse import event_time, parse_lines

CASES = [
    # line, timestamp, level, component, message, parse_error
    ("2024-01-01 00:00:07 ERROR auth Login failed for bob", "2024-01-01 00:00:07", "ERROR", "auth", "Login failed for bob", None),
    ("2024-01-01 00:00:07 INFO auth", "2024-01-01 00:00:07", "INFO", "auth", "", None),
    ("2024-01-01 00:00:07  INFO auth x", "2024-01-01 00:00:07", "", "INFO", "auth x", None),
    ("2024-01-01 00:00:07 INFO auth a  b", "2024-01-01 00:00:07", "INFO", "auth", "a  b", None),
    ("foo bar baz qux quux", "foo bar", "baz", "qux", "quux", None),
    ("2024-01-01 00:00:07,123 INFO auth x", "2024-01-01 00:00:07,123", "INFO", "auth", "x", None),
    ("one two three", None, None, None, None, "list index out of range"),
    ("\t 2024-01-01 00:00:07 ERROR auth Login failed for bob  \t", "2024-01-01 00:00:07", "ERROR", "auth", "Login failed for bob", None),
]


def test_parser_cases(spark):
    lines = [c[0] for c in CASES] + [" \t  "]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    out = {r["i"]: r for r in parse_lines(df, "value", keep=["i"]).collect()}
    assert len(out) == len(CASES)          # the blank line is dropped
    for i, (_, ts, lvl, comp, msg, err) in enumerate(CASES):
        r = out[i]
        assert (r["timestamp"], r["log_level"], r["component"], r["message"], r["parse_error"]) == (ts, lvl, comp, msg, err)


def test_typed_timestamp_quarantine(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07",), ("foo bar",), ("2024-01-01 00:00:07,123",)], "t string")
    got = [r[0] for r in df.select(event_time(F.col("t"))).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None


def test_keywords(spark):
    from loglens.operators.features import keyword_hits
    df = spark.createDataFrame([("Login FAILED",), ("failure",), ("terrors",), (None,)], "message string")
    rows = df.select(F.filter(F.array(*keyword_hits(F.col("message"))), lambda x: x.isNotNull()).alias("k")).collect()
    assert sorted(rows[0]["k"]) == ["keyword_fail", "keyword_failed"]
    assert rows[1]["k"] == ["keyword_fail"]
    assert rows[2]["k"] == ["keyword_error"]
    assert rows[3]["k"] == []


def test_line_time_equals_the_parsed_timestamp(spark):
    from loglens.functions.parse import line_time

    lines = ["2024-01-01 00:00:07 ERROR auth Login failed", "2024-01-01 00:00:07 INFO auth", "2024-01-01 00:00:07 INFO", "2024-01-01 00:00:07  INFO auth",
             "2024-01-01 00:00:07   ", " 2024-01-01 00:00:07 A B\t", "2024-02-30 00:00:07 A B c", "2024-01-01 24:00:07 A B", "2024-01-01  00:00:07 A B",
             "2024-01-01 00:00:07,5 A B", "x2024-01-01 00:00:07 A B", "2024-1-01 00:00:07 A B", "2024-01-01 00:00:07 A B c", "2024-01-01 00:00:07 A B c d",
             "2024-01-01 00:00:07 A\nB c", "short", "", "2024-01-01 00:00:07 A  B", "2024-01-01 00:00:0٧ A B c", "2024-01-01 00:00:07 A B c d e f"]
    df = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = df.select("raw_log", event_time(F.col("timestamp")).alias("a"), line_time(F.col("raw_log")).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] and sum(r.a is not None for r in rows) >= 6
