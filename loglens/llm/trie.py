"""Conversation prefix trie by whole-sequence collapse.

Conversations are rebuilt (a shared head from the first of their family, then
their own turns) and every turn gets two 64-bit keys from its depth and
contents.  The exclusive or of a conversation's keys down to a depth names that
prefix: it can be summed in any order and in parts, so no task walks a whole
conversation, and equal prefixes of different conversations get equal names.

1. Identical conversations collapse to one sequence with a weight, a smallest
   conversation and a list of the conversations that end there.
2. Proper prefixes are the names at depths below a sequence's length; sequences
   left by the anti-join with them are the leaves.
3. Sequences expand to their prefixes with their weights, and one aggregate per
   prefix gives members, smallest member and leaves.
4. Sums over subtrees: a node's own value is booked on the sequence of its
   smallest member.  Those nodes are the lower end of that sequence, so the sum
   below a node is the total of all sequences through it, less what its own
   sequence has above it (a running sum).

Everything is DataFrame work but the digest of an end list, which is a stream
over its sorted ids: those are joined to texts of ID_SPAN ids first, and a task
feeds them to the hash one by one, so no list is ever held as a whole.  Running
sums go by blocks of BLOCK rows, then over blocks.

Defined results: turns with an equal number are ordered by a hash of role and
text; repeated rows are turns of their own; a null role or text is empty; rows
without conv_id belong to no conversation and stay out; an empty table has no
node.  The base of c is c - c % base with the sign of c.  Other columns never
matter, whatever their names.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WS, keep_only, map_arrow, pick, stored, table

WORD = "[^" + WS[1:] + "+"
FAMILY, HEAD = 20, 4
BLOCK = 1024
ID_SPAN = 512
NODE = ["depth", "p1", "p2"]


def running(df: DataFrame, keys: list[str], at: str, **sums: Column) -> DataFrame:
    """``df`` with running aggregates down ``at`` (a whole number, null first),
    this row included; ``at`` is distinct within the keys.  ``sums`` maps new
    columns to aggregates that can be applied to their own results (sum, bit_xor).
    A window holds at most the rows of BLOCK numbers, or the blocks of a key."""
    block = F.coalesce(F.floor(F.col(at) / BLOCK), F.lit(-2**62)).cast("long")
    rows = df.withColumn("_block", block)
    inside = W.partitionBy(*keys, "_block").orderBy(F.col(at).asc_nulls_first())
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    whole = rows.groupBy(*keys, "_block").agg(*[fn(F.col(c)).alias(f"_{n}") for n, (fn, c) in sums.items()])
    above = whole.select(*keys, "_block", *[fn(F.col(f"_{n}")).over(before).alias(f"_{n}") for n, (fn, _) in sums.items()])
    own = rows.select("*", *[fn(F.col(c)).over(inside).alias(n) for n, (fn, c) in sums.items()])
    joined = own.join(above, [*keys, "_block"])
    for n, (fn, _) in sums.items():
        both = F.col(n).bitwiseXOR(F.coalesce(f"_{n}", F.lit(0))) if fn is F.bit_xor else F.col(n) + F.coalesce(f"_{n}", F.lit(0))
        joined = joined.withColumn(n, both)
    return joined.drop("_block", *[f"_{n}" for n in sums])


# ------------------------------------------------------------ conversations

def turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(c, pos, what, words) of every original turn, pos from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = pick(df, c=id_col, turn=turn_col, role=role_col, text=text_col).filter("c IS NOT NULL").select(
        "c", "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("what"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = stored(rows, "turns")
    first = running(rows.groupBy("c", "turn").agg(F.count(F.lit(1)).alias("n")), ["c"], "turn", upto=(F.sum, "n"))
    tie = F.row_number().over(W.partitionBy("c", "turn").orderBy("what"))
    placed = rows.withColumn("tie", tie).alias("r").join(first.alias("f"), F.col("r.c").eqNullSafe(F.col("f.c")) & F.col("r.turn").eqNullSafe(F.col("f.turn")))
    return placed.select("r.c", (F.col("upto") - F.col("n") + F.col("tie")).alias("pos"), "what", "words")


def rebuilt(placed: DataFrame, family: int = FAMILY, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """((c, n) of every conversation after rebuilding, (c, depth, what, words))."""
    lengths = placed.groupBy("c").agg(F.count(F.lit(1)).alias("had"))
    ids = lengths.select("c", "had", (F.col("c") - F.col("c") % family).alias("base"),
                         (F.crc32(F.col("c").cast("string").cast("binary")) % head).alias("h"))
    of_base = lengths.select(F.col("c").alias("base"), F.col("had").alias("base_had"))
    ids = stored(ids.join(of_base, "base", "left").select("c", "had", "base", "h", F.least("h", F.coalesce("base_had", F.lit(0))).alias("hb")), "convs")
    heads = placed.filter(F.col("pos") < head).select(F.col("c").alias("base"), "pos", "what", "words")
    shared = ids.filter("hb > 0").join(heads, "base").filter("pos <= hb").select("c", F.col("pos").alias("depth"), "what", "words")
    own = placed.join(ids, "c").filter("pos > h").select("c", (F.col("pos") - F.col("h") + F.col("hb")).alias("depth"), "what", "words")
    convs = ids.select("c", (F.col("hb") + F.greatest(F.col("had") - F.col("h"), F.lit(0))).alias("n"))
    return convs, shared.unionByName(own)


# --------------------------------------------------------------- end digests

def end_digests(ends: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., ends_sha256) of (keys..., c): the ids in ascending order."""
    span = F.floor(F.col("c") / ID_SPAN).alias("span")
    chunks = ends.groupBy(*keys, span).agg(F.array_join(F.array_sort(F.collect_list("c")), ",").alias("ids"))
    parts = chunks.repartition(*keys).sortWithinPartitions(*keys, "span").select(*keys, "ids")
    width = len(keys)

    def run(batches):
        keep_only("trie")
        key, digest = None, None
        for b in batches:
            done = []
            for *mine, ids in zip(*(c.to_pylist() for c in b.columns)):
                if mine != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = mine, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _batch(done, names, types)
        if key is not None:
            yield _batch([(*key, digest.hexdigest())], names, types)

    names, types = [*keys, "ends_sha256"], [pa.int64()] * width + [pa.string()]
    return map_arrow(parts, run, ", ".join(f"{k} long" for k in keys) + ", ends_sha256 string")


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


# ---------------------------------------------------------------------- trie

def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per node from (c, n) and (c, depth, what, words)."""
    keyed = rows.select("c", "depth", "words", F.xxhash64("depth", "what").alias("z1"), F.xxhash64("what", F.lit("trie"), "depth").alias("z2"))
    keyed = stored(keyed, "rebuilt_turns")

    # 1. whole sequences
    whole = keyed.groupBy("c").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("z1").alias("p1"), F.bit_xor("z2").alias("p2"))
    none = F.lit(0).cast("long")
    each = stored(convs.join(whole, "c", "left").select("c", *[F.coalesce(k, none).alias(k) for k in NODE]), "whole")
    sequences = stored(each.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")), "sequences")
    digests = end_digests(each.select(*NODE, "c"), NODE)

    # 2. prefixes of one conversation a sequence; leaves
    one = running(keyed.join(sequences.select("c", "n", F.col("depth").alias("len")), "c"), ["c"], "depth", p1=(F.bit_xor, "z1"), p2=(F.bit_xor, "z2"))
    down = one.select("c", "n", "len", *NODE, F.col("p1").bitwiseXOR(F.col("z1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("z2")).alias("q2"), "words")
    root = sequences.select("c", "n", F.col("depth").alias("len"), none.alias("depth"), none.alias("p1"), none.alias("p2"), none.alias("q1"), none.alias("q2"), none.alias("words"))
    prefixes = stored(down.unionByName(root), "prefixes")
    proper = prefixes.filter("depth < len").select(*NODE).distinct()
    leaves = stored(sequences.join(proper, NODE, "left_anti").select("c", F.lit(1).cast("long").alias("leaf")), "leaves")

    # 3. weighted prefixes
    marked = prefixes.join(leaves, "c", "left")
    nodes = stored(marked.groupBy(*NODE).agg(
        F.sum("n").alias("n_convs"), F.min("c").alias("conv_id"), F.coalesce(F.sum("leaf"), none).alias("n_leaves"), F.max("words").alias("words"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2")).withColumn("own", (F.col("n_convs") - 1) * F.col("words")), "nodes")

    # 4. sums over subtrees; children; end digests
    booked = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.sum("own").alias("total"))
    through = prefixes.select(*NODE, "c").join(booked, "c").groupBy(*NODE).agg(F.sum("total").alias("total"), none.alias("children"), F.lit(None).cast("string").alias("ends"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        none.alias("total"), F.count(F.lit(1)).alias("children"), F.lit(None).cast("string").alias("ends"))
    ended = digests.select(*NODE, none.alias("total"), none.alias("children"), F.col("ends_sha256").alias("ends"))
    facts = through.unionByName(children).unionByName(ended).groupBy(*NODE).agg(
        F.sum("total").alias("total"), F.sum("children").alias("n_children"), F.max("ends").alias("ends"))
    above = running(nodes.select(*NODE, "conv_id", "n_convs", "n_leaves", "q1", "q2", "own"), ["conv_id"], "depth", upto=(F.sum, "own"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    saved = F.col("total") - (F.col("upto") - F.col("own"))
    return (above.join(facts, NODE).join(parents, ["depth", "q1", "q2"], "left")
            .withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id")))
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
                    F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def conversation_trie(df: DataFrame, family: int = FAMILY, head: int = HEAD, **cols: str) -> DataFrame:
    """The prefix trie of the rebuilt conversations of a table."""
    convs, rows = rebuilt(stored(turns(df, **cols), "placed"), family, head)
    return trie(convs, rows)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


SQL_OP13 = rf"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i::BIGINT, range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)),
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
          md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS what,
          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
        FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, count(*) AS had, c - c % {FAMILY} AS base,
          xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                          lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % {HEAD} AS h
        FROM own, crc_table GROUP BY c, t),
shape AS (SELECT i.c, i.base, i.h, i.had, least(i.h, coalesce(b.had, 0)) AS hb FROM ids i LEFT JOIN ids b ON b.c = i.base),
re AS (SELECT s.c, o.pos AS d, o.what, o.words FROM shape s JOIN own o ON o.c = s.base AND o.pos <= s.h
       UNION ALL SELECT s.c, o.pos - s.h + s.hb, o.what, o.words FROM shape s JOIN own o ON o.c = s.c AND o.pos > s.h),
pre AS (SELECT c, d, string_agg(what, ',') OVER (PARTITION BY c ORDER BY d) AS p, words FROM re
        UNION ALL SELECT c, 0, '', 0 FROM ids),
len AS (SELECT c, max(d) AS n FROM pre GROUP BY c),
node AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends_sha256
         FROM pre JOIN len USING (c) GROUP BY d, p),
kid AS (SELECT d - 1 AS d, left(p, greatest(0, (32 + 1) * (d - 1) - 1)::INT) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
below AS (SELECT u.d, u.p, sum((v.n_convs - 1) * v.words) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
          FROM node v JOIN pre u ON u.c = v.conv_id AND u.d <= v.d LEFT JOIN kid k ON k.d = v.d AND k.p = v.p GROUP BY u.d, u.p)
SELECT v.conv_id, v.d::BIGINT AS depth, w.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM node v JOIN below b ON b.d = v.d AND b.p = v.p LEFT JOIN kid k ON k.d = v.d AND k.p = v.p
LEFT JOIN node w ON w.d = v.d - 1 AND w.p = left(v.p, greatest(0, (32 + 1) * (v.d - 1) - 1)::INT)
"""

QUERIES = {"op13_prefix_trie": op13_prefix_trie}
SQL: dict[str, str] = {"op13_prefix_trie": SQL_OP13}
