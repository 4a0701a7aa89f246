import hashlib

import numpy as np
import pytest

from loglens.llm import linededup as L

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=5, min_chars=40):
    """Per row: (id, lines, dropped, digest of what is left); rows with one id are one document."""
    last = 2**63 - 1
    key = lambda x: x.strip(BLANK).translate(LOWER)
    held = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held.setdefault(k, set()).add(last if i is None else i)
    count, top = {k: len(d) for k, d in held.items()}, {k: max(d) for k, d in held.items()}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count.get(key(x), 0) < min_docs or top[key(x)] == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def reported(index, docs):
    return sorted(map(tuple, L.report(index, docs).collect()), key=lambda r: (r[0] is None, r))


def test_filter_adds_and_removes():
    rng = np.random.default_rng(1)
    k = rng.integers(-2**63, 2**63 - 1, (4000, 2))
    f = L.CuckooFilter.built(k[:3000, 0], k[:3000, 1])
    f = L.CuckooFilter.loaded(f.buckets, f.dumped())
    assert f.has(k[:3000, 0], k[:3000, 1]).all() and f.has(k[3000:, 0], k[3000:, 1]).mean() < 0.01
    f.remove(k[:1500, 0], k[:1500, 1])
    assert f.has(k[1500:3000, 0], k[1500:3000, 1]).all() and f.has(k[:1500, 0], k[:1500, 1]).mean() < 0.01
    small = L.CuckooFilter(4)
    assert not small.add(k[:100, 0], k[:100, 1])


def test_edge_rows(edge_docs, edge_rows, no_docs):
    assert reported(L.build(edge_docs), edge_docs) == brute([r[:2] for r in edge_rows])
    assert reported(L.build(no_docs), no_docs) == []


@pytest.mark.parametrize("part", [1, 200_000])
def test_filters_change_nothing(edge_docs, edge_rows, monkeypatch, part):
    monkeypatch.setattr(L, "PROBE_ROWS", part)      # many parts a shard
    monkeypatch.setattr(L, "SHARD_KEYS", 1)
    assert reported(L.build(edge_docs, min_docs=2), edge_docs) == brute([r[:2] for r in edge_rows], 2)


def test_the_filters_let_few_others_pass(spark, monkeypatch):
    monkeypatch.setattr(L, "PROBE_ROWS", 300)
    line = lambda n: f"a line with the number {n} that is long enough to count"
    rows = [(i, "\n".join([line("hot")] + [line(n) for n in range(i % 5 * 10, i % 5 * 10 + 10)] + [line(f"{i}/{n}") for n in range(40)])) for i in range(60)]
    index = L.build(spark.createDataFrame(rows, "doc_id long, text string"))
    passed = L.probed(index, index.refs)
    repeated = {(r.k1, r.k2) for r in index.counts.filter("n_docs >= 5").collect()}
    keys = [(r.k1, r.k2, r.doc) for r in passed.collect()]
    real = [k for k in keys if k[:2] in repeated]
    assert len(repeated) == 51 and len(real) == len(set(real)) == 60 * 11 and len(keys) <= len(real) + 60


def test_rows_of_one_id_are_one_document_as_in_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    line = lambda n: f"a line with the number {n} that is long enough to count"
    rows = [(7, line(1))] * 6 + [(i, line(2)) for i in (1, 2, 3, 4, 4, 4)] + [(i, f"{line(3)}\n short\n{line(3)}") for i in (1, 2, 4, 8, 9, 9)]
    rows += [(None, line(4))] * 5 + [(i, line(5)) for i in (1, 2, 3, 4, None, None)] + [(11, None), (11, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = reported(L.build(docs), docs)
    assert got == brute(rows) and sum(r[2] for r in got) == 8 + 4
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    assert sorted(con.execute(L.SQL_OP4).fetchall(), key=lambda r: (r[0] is None, r)) == got


def test_an_id_inserted_again_gets_more_lines(spark):
    line = lambda n: f"a line with the number {n} that is long enough to count"
    first, more = [(i, line(i % 2)) for i in range(12)], [(i, f"{line(0)}\n{line(1)}") for i in range(6, 9)]
    a, b = (spark.createDataFrame(x, "doc_id long, text string") for x in (first, more))
    state = lambda x: (sorted(map(tuple, x.counts.select("k1", "k2", "n_docs", "max_doc").collect())),
                       sorted(map(tuple, x.refs.select("k1", "k2", "doc").collect())))
    assert state(L.insert(L.build(a), b)) == state(L.build(a.unionByName(b)))


def test_insertions_and_deletions_are_reversible(spark):
    schema = "doc_id long, text string"
    line = lambda n: f"a line with the number {n} that is long enough to count"
    first = [(i, "\n".join(line(n) for n in range(i % 7 + 1))) for i in range(20)]
    more = [(100 + i, "\n".join([line(i % 9), line(3), "short"])) for i in range(12)]
    a, b = spark.createDataFrame(first, schema), spark.createDataFrame(more, schema)
    state = lambda x: (sorted(map(tuple, x.counts.select("k1", "k2", "n_docs", "max_doc").collect())),
                       sorted(map(tuple, x.refs.select("k1", "k2", "doc").collect())))
    start = L.build(a)
    grown = L.insert(start, b)
    assert state(grown) == state(L.build(a.unionByName(b)))
    assert reported(grown, a.unionByName(b)) == brute(first + more)
    back = L.delete(grown, b.select("doc_id"))
    assert state(back) == state(start) and reported(back, a) == brute(first)
    gone = L.delete(start, spark.createDataFrame([(19,), (13,), (6,)], "doc_id long"))
    left = [r for r in first if r[0] not in (19, 13, 6)]
    assert reported(gone, spark.createDataFrame(left, schema)) == brute(left)


def test_apply_keeps_columns_and_nulls(edge_docs, edge_rows):
    out = L.apply(L.build(edge_docs), edge_docs)
    assert out.columns == edge_docs.columns
    assert sum(r[1] is None for r in out.collect()) == sum(r[1] is None for r in edge_rows)
