import math
import re
from collections import Counter

from loglens.llm import rules


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(g)
    cover = {j for i, x in enumerate(g) if c[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover),
            len(w) < 50 or 100 * len(cover) > 50 * len(w))


def test_base_counts_of_edge_rows(edge_docs, edge_rows, no_docs):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                 for r in rules.judged(edge_docs).collect())
    assert got == sorted((i is None, i or 0, *base(t)) for i, t, *_ in edge_rows)
    assert rules.judged(no_docs).collect() == []


def test_repeats_and_symbols(spark):
    texts = ["a b c a b c", "a a a a", "x " * 60, "# * $ % & | < >", "one\n one\none\n\n\n \none", "a b", "1 2 3 4 1 2 3"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "'en' AS lang")
    got = {r["doc_id"]: tuple(r[1:7]) for r in rules.judged(rows).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_distance(spark):
    p, q = [3.0, 1.0, 0.0, 4.0], [1.0, 1.0, 2.0, 0.0]
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    term = lambda x, y: x * math.log2(2 * x / (x + y)) if x else 0.0
    want = math.sqrt(sum(term(x, y) + term(y, x) for x, y in zip(a, b)) / 2)
    from pyspark.sql import functions as F
    got = spark.range(1).select(rules.jensen_shannon(F.lit(p), F.lit(q)).alias("d"), rules.jensen_shannon(F.lit(p), F.lit(p)).alias("z")).first()
    assert abs(got["d"] - want) < 1e-12 and got["z"] < 1e-9


def test_labels_of_small_tables(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").join(rules.op1_divergence_rules(spark, "/root/testdata/sf0.01"), "doc_id").toPandas()
    long_ = d[~d.base_failed]
    assert long_[long_.quality == 1].kept.mean() > 0.99 and d[d.quality == 0].kept.mean() < 0.15


def test_no_python_in_the_plan(spark, edge_docs):
    plan = rules.judged(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
