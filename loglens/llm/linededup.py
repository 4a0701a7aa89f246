"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line stripped of white space with A-Z lower-cased, as a
128-bit hash.  The index of a corpus has three tables:

* ``refs``    (k1, k2, doc): which document holds which key, exact;
* ``counts``  (k1, k2, n_docs, max_doc): reference counts, exact;
* ``filters`` (shard, buckets, table): one cuckoo filter per key shard, holding
  the keys found in ``min_docs`` documents or more.

``insert`` and ``delete`` add or take documents and give a new index: counts
change for the touched keys only, and each filter takes or drops just the
fingerprints of keys that crossed ``min_docs`` (a shard that overflows is built
again, larger, from the exact table).  ``apply`` drops lines: a document's keys
are probed in the filters first, and what passes is confirmed by the exact
table, so a false positive never drops a line.  Filters stay sharded: each goes
to the parts of its shard's references (PROBE_ROWS a part, about), whatever
their number, and never to the driver.

Rules: keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines but those in the largest doc id.
Defined results: a null or empty text is one empty line; a null id counts as
the largest id; rows with the same id (or none) are one document, counted once,
and keep or lose their lines together; empty tables give empty results; other
columns pass through untouched.  A hot line is counted per task before any shuffle, and
the join on keys is one that Spark can split.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import id_or_last, is_empty, keep_only, map_arrow, pick, stored, table

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys in a shard's filter, and references probed at a time, about.
SHARD_KEYS = 1 << 16
PROBE_ROWS = 200_000
#: Rounds in which a filter moves residents before it counts as too full.
MAX_KICKS = 500
SLOTS = 4
BLANK = b" \t\n\x0b\x0c\r"


# ---------------------------------------------------------------- line keys

def key_of(line: bytes, min_chars: int) -> bytes | None:
    """16-byte key of a line, None if it is too short to be dropped."""
    k = line.strip(BLANK)
    if len(k) < min_chars or (not k.isascii() and len(k.decode()) < min_chars):
        return None
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(k.lower())     # bytes.lower() lowers A-Z only


def utf8_list(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def occurrences(df: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, doc), stored, once for each document and key; only documents of
    several rows need to be made distinct."""
    refs = stored(row_keys(df, min_chars, id_col, text_col), "line_refs")
    again = pick(df, doc=id_col).groupBy(id_or_last("doc").alias("doc")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc")
    again = stored(again, "line_repeated_ids")
    if is_empty(again):
        return refs
    once = refs.join(again, "doc", "left_semi").select("k1", "k2", "doc").distinct()
    return stored(refs.join(again, "doc", "left_anti").select("k1", "k2", "doc").unionByName(once), "line_refs")


def row_keys(df: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, doc) once for each row and key."""
    rows = pick(df, doc=id_col, text=text_col).withColumn("doc", id_or_last("doc"))

    def run(batches):
        keep_only("linededup")
        for b in batches:
            keys, docs = [], []
            for doc, text in zip(b.column(0).to_pylist(), utf8_list(b.column(1))):
                mine = {key_of(line, min_chars) for line in (text or b"").split(b"\n")} - {None}
                keys += mine
                docs += [doc] * len(mine)
            k = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1])), pa.array(docs, pa.int64())], ["k1", "k2", "doc"])

    return map_arrow(rows, run, "k1 long, k2 long, doc long")


# ------------------------------------------------------------- cuckoo filter

def _mix(x: np.ndarray) -> np.ndarray:
    x = np.atleast_1d(x)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def one_each(buckets: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Positions of one key a bucket among those marked in ``which``."""
    at = np.flatnonzero(which)
    return at[np.unique(buckets[at], return_index=True)[1]]


class CuckooFilter:
    """Partial-key cuckoo filter: 16-bit fingerprints, SLOTS a bucket.  Keys are
    pairs of longs; supports add, remove and vectorised lookup."""

    def __init__(self, buckets: int, table_: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table_ is None else table_

    @classmethod
    def of_size(cls, n: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, n) / (SLOTS * 0.8))))))

    @classmethod
    def built(cls, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        f = cls.of_size(len(k1))
        while not f.add(k1, k2):
            f = cls(f.buckets * 2)
        return f

    @classmethod
    def loaded(cls, buckets: int, data: bytes) -> CuckooFilter:
        return cls(buckets, np.frombuffer(data, np.uint16).reshape(buckets, SLOTS).copy())

    def dumped(self) -> bytes:
        return self.table.tobytes()

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = _mix(np.asarray(k1).astype(np.int64).view(np.uint64) ^ _mix(np.asarray(k2).astype(np.int64).view(np.uint64)))
        mark = (h >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        i = (h & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, i, self.other(i, mark)

    def other(self, i, mark):
        step = _mix(np.atleast_1d(mark).astype(np.uint64) + np.uint64(1)) & np.uint64(self.buckets - 1)
        return i ^ step.astype(np.int64)

    def add(self, k1, k2) -> bool:
        """False if the filter is too full; it must then be built anew.  All keys
        advance together: in a round each bucket takes one key into a free slot,
        and of the keys without one, one a bucket moves a resident on."""
        rng = np.random.default_rng(len(k1))
        mark, i, j = self.places(k1, k2)
        for _ in range(MAX_KICKS):
            if not len(mark):
                return True
            in_i = (self.table[i] == 0).any(axis=1)
            at = np.where(in_i, i, j)
            free = self.table[at] == 0
            fits = free.any(axis=1)
            put = one_each(at, fits)
            self.table[at[put], free[put].argmax(axis=1)] = mark[put]
            at = np.where(rng.integers(2, size=len(i)) == 0, i, j)
            move, slot = one_each(at, ~fits), rng.integers(SLOTS, size=len(i))
            move = move[(self.table[at[move]] != 0).all(axis=1)]
            b, s = at[move], slot[move]
            mark[move], self.table[b, s] = self.table[b, s], mark[move]
            i[move] = j[move] = self.other(b, mark[move])
            left = np.ones(len(mark), bool)
            left[put] = False
            mark, i, j = mark[left], i[left], j[left]
        return not len(mark)

    def remove(self, k1, k2) -> None:
        """Keys must have been added before."""
        mark, i, j = self.places(k1, k2)
        while len(mark):
            at = np.where((self.table[i] == mark[:, None]).any(axis=1), i, j)
            hit = self.table[at] == mark[:, None]
            found = hit.any(axis=1)
            out = one_each(at, found)
            self.table[at[out], hit[out].argmax(axis=1)] = 0
            left = found.copy()
            left[out] = False
            mark, i, j = mark[left], i[left], j[left]

    def has(self, k1, k2) -> np.ndarray:
        m, i, j = self.places(k1, k2)
        return ((self.table[i] == m[:, None]) | (self.table[j] == m[:, None])).any(axis=1)


# -------------------------------------------------------------------- index

@dataclass
class LineIndex:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int


FILTERS = "shard int, buckets int, data binary"


def shard_of(shards: int):
    return F.col("k1").bitwiseAND(F.lit(shards - 1)).cast("int")


def counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("max_doc"))


def built_filters(repeated: DataFrame, shards: int) -> DataFrame:
    """One filter per shard from the repeated keys (SHARD_KEYS a shard, about)."""

    def build(pdf):
        import pandas as pd

        f = CuckooFilter.built(pdf["k1"].to_numpy(), pdf["k2"].to_numpy())
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "buckets": [f.buckets], "data": [f.dumped()]})

    return repeated.select("k1", "k2", shard_of(shards).alias("shard")).groupBy("shard").applyInPandas(build, FILTERS)


def build(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, **cols: str) -> LineIndex:
    """Index of a corpus (an insertion into an empty index, in bulk)."""
    refs = occurrences(docs, min_chars, **cols)
    counts = stored(counted(refs), "line_counts")
    n = counts.filter(F.col("n_docs") >= min_docs).count()
    shards = 1 << max(0, int(np.ceil(np.log2(max(1, n) / SHARD_KEYS))))
    filters = stored(built_filters(counts.filter(F.col("n_docs") >= min_docs), shards), "line_filters")
    return LineIndex(refs, counts, filters, shards, min_docs)


def _with_changes(index: LineIndex, refs: DataFrame, touched: DataFrame) -> LineIndex:
    """``index`` after the counts of the touched keys became ``touched``
    (k1, k2, n_docs, max_doc; n_docs 0: gone)."""
    new = stored(index.counts.join(touched, ["k1", "k2"], "left_anti").unionByName(touched.filter("n_docs > 0")), "line_counts")
    was = index.counts.select("k1", "k2", F.col("n_docs").alias("before"))
    least = F.lit(index.min_docs)
    n = new.filter(F.col("n_docs") >= least).count()
    if n > 2 * index.shards * SHARD_KEYS:      # grown out of its shards
        shards = 1 << int(np.ceil(np.log2(n / SHARD_KEYS)))
        filters = stored(built_filters(new.filter(F.col("n_docs") >= least), shards), "line_filters")
        return LineIndex(refs, new, filters, shards, index.min_docs)
    crossed = (touched.join(was, ["k1", "k2"], "left")
               .withColumn("in_", F.coalesce("before", F.lit(0)) >= least).withColumn("now", F.col("n_docs") >= least)
               .filter("in_ <> now").select("k1", "k2", "now", shard_of(index.shards).alias("shard")))
    keys = new.filter(F.col("n_docs") >= least).select("k1", "k2", shard_of(index.shards).alias("shard"))
    least_shards = crossed.select("shard").distinct()
    full = keys.join(least_shards, "shard", "left_semi").groupBy("shard").agg(F.collect_list("k1").alias("a"), F.collect_list("k2").alias("b"))
    old = index.filters.join(full, "shard", "full").select("shard", "buckets", "data", "a", "b")

    def change(key, left, right):
        import pandas as pd

        row = left.iloc[0] if len(left) else None
        if len(right) == 0 and row is not None:
            return pd.DataFrame({"shard": [key[0]], "buckets": [row["buckets"]], "data": [row["data"]]})
        arrays = lambda c: np.array(row[c] if row is not None and row[c] is not None else [], dtype=np.int64)
        if row is None or row["data"] is None:
            f = CuckooFilter.built(arrays("a"), arrays("b"))
        else:
            f = CuckooFilter.loaded(int(row["buckets"]), bytes(row["data"]))
            gone, come = right[~right["now"]], right[right["now"]]
            f.remove(gone["k1"].to_numpy(), gone["k2"].to_numpy())
            if not f.add(come["k1"].to_numpy(), come["k2"].to_numpy()):
                f = CuckooFilter.built(arrays("a"), arrays("b"))
        return pd.DataFrame({"shard": [key[0]], "buckets": [f.buckets], "data": [f.dumped()]})

    filters = stored(old.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(change, FILTERS), "line_filters")
    return LineIndex(refs, new, filters, index.shards, index.min_docs)


def insert(index: LineIndex, docs: DataFrame, min_chars: int = MIN_CHARS, **cols: str) -> LineIndex:
    """The index with more documents; a document that it holds gets more lines."""
    more = occurrences(docs, min_chars, **cols)
    held = index.refs.join(more.select("doc").distinct(), "doc", "left_semi")
    more = stored(more.join(held, ["k1", "k2", "doc"], "left_anti"), "line_refs")
    keys = more.select("k1", "k2").distinct()
    touched = (index.counts.join(keys, ["k1", "k2"], "left_semi").unionByName(counted(more))
               .groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc")))
    return _with_changes(index, index.refs.unionByName(more), stored(touched, "line_touched"))


def delete(index: LineIndex, doc_ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
    """The index without the documents of these ids, as if never inserted."""
    gone = pick(doc_ids, doc=id_col).select(id_or_last("doc").alias("doc")).distinct()
    refs = stored(index.refs.join(gone, "doc", "left_anti").select("k1", "k2", "doc"), "line_refs")
    keys = stored(index.refs.join(gone, "doc", "left_semi").select("k1", "k2").distinct(), "line_keys")
    left = counted(refs.join(keys, ["k1", "k2"], "left_semi"))
    touched = keys.join(left, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "max_doc")
    return _with_changes(index, refs, stored(touched, "line_touched"))


# -------------------------------------------------------------------- apply

def probed(index: LineIndex, refs: DataFrame) -> DataFrame:
    """The refs whose key may be repeated, by the filters.  A shard's references
    (a hot key may hold a third of all) are dealt into parts by their number, and
    its filter goes to each of them."""
    ship_package(refs.sparkSession)
    placed = refs.select("k1", "k2", "doc", shard_of(index.shards).alias("shard"))
    parts = stored(placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(PROBE_ROWS)).cast("int").alias("parts")), "line_parts")
    by_shard = parts.agg(F.map_from_entries(F.collect_list(F.struct("shard", "parts"))).alias("by_shard"))   # a pair for SHARD_KEYS repeated keys
    part = F.pmod(F.xxhash64("doc", "k2", "k1"), F.element_at("by_shard", F.col("shard"))).cast("int")
    dealt = placed.crossJoin(F.broadcast(by_shard)).withColumn("part", part).drop("by_shard")                # one row
    copies = index.filters.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "buckets", "data")

    def run(left, right):
        keep_only("linededup")
        if not len(right):
            return left.iloc[:0][["k1", "k2", "doc"]]
        f = CuckooFilter.loaded(int(right["buckets"].iloc[0]), bytes(right["data"].iloc[0]))
        return left.loc[f.has(left["k1"].to_numpy(np.int64), left["k2"].to_numpy(np.int64)), ["k1", "k2", "doc"]]

    return dealt.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInPandas(run, "k1 long, k2 long, doc long")


def drops(index: LineIndex, refs: DataFrame | None = None) -> DataFrame:
    """(doc, keys): 16-byte keys whose lines the document loses."""
    repeated = index.counts.filter(F.col("n_docs") >= index.min_docs).select("k1", "k2", "max_doc")
    hits = probed(index, index.refs if refs is None else refs).join(repeated, ["k1", "k2"]).filter("doc <> max_doc")
    return hits.groupBy("doc").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))


def kept_text(text: bytes, gone: list, min_chars: int) -> tuple[bytes, int, int]:
    """(text without the lines of these keys, lines before, lines dropped)"""
    lines = text.split(b"\n")
    if not gone:
        return text, len(lines), 0
    keys = {int(k["k1"]).to_bytes(8, "little", signed=True) + int(k["k2"]).to_bytes(8, "little", signed=True) for k in gone}
    left = [x for x in lines if key_of(x, min_chars) not in keys]
    return b"\n".join(left), len(lines), len(lines) - len(left)


def _joined(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    plain = docs.toDF(*[f"__{i}" for i in range(len(docs.columns))])
    return plain.withColumn("doc", id_or_last(f"__{docs.columns.index(id_col)}")).join(gone, "doc", "left").drop("doc")


def apply(index: LineIndex, docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all of them in the index) with their remaining text; a null
    text stays null."""
    rows, at = _joined(docs, drops(index), id_col), docs.columns.index(text_col)
    fields = rows.schema.fields[:-1]

    def run(batches):
        for b in batches:
            new = [None if t is None else kept_text(t, k, min_chars)[0].decode() for t, k in zip(utf8_list(b.column(at)), b.column(len(fields)).to_pylist())]
            cols = b.columns[:-1]
            cols[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    return map_arrow(rows, run, T.StructType(fields)).toDF(*docs.columns)


def report(index: LineIndex, docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256; texts stay in the workers."""
    two = pick(docs, doc_id=id_col, text=text_col)
    rows = _joined(two, drops(index), "doc_id")

    def run(batches):
        for b in batches:
            out = [kept_text(t or b"", k, min_chars) for t, k in zip(utf8_list(b.column(1)), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for _, n, _ in out], pa.int64()), pa.array([d for _, _, d in out], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t, _, _ in out], pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return map_arrow(rows, run, T.StructType([two.schema["doc_id"], T.StructField("n_lines", T.LongType()),
                                              T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return report(build(docs), docs)


SQL_OP4 = r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
                     string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT row, doc_id, doc, i, l, translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row, doc_id, doc, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM docs)),
hot AS (SELECT k, max(doc) AS last FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc) >= 5),
marked AS (SELECT lines.*, hot.k IS NOT NULL AND doc <> hot.last AS gone FROM lines LEFT JOIN hot USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
"""

QUERIES = {"op4_line_dedup": op4_line_dedup}
SQL: dict[str, str] = {"op4_line_dedup": SQL_OP4}
