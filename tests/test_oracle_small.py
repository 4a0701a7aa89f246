"""Each registered query against its DuckDB statement on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "events embeddings documents".split()
FAST = ["parse_logs", "quarantine_logs", "window_features", "minute_pivot", "dedup_message", "standard_scale",
        "minmax_scale", "naive_forecast_errors", "error_threshold", "cluster_profile", "message_anomalies",
        "severity", "alert_cooldown", "alert_outbox", "incidents", "related_logs", "incident_context",
        "incident_state", "analysis_patterns", "tickets", "response_decision"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, sf_small, con, name):
    spark.catalog.clearCache()
    df = E.queries()[name](spark, sf_small)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, res.fetchall())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "grade" in df.columns
