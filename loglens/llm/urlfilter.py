"""URL filters: rules by host and path, then an exact Bloom filter cascade.

A blocklist names addresses (host and path, without query and fragment).  The
cascade answers whether an address is listed, without a join: level 0 is a
Bloom filter of the listed keys, level 1 one of the unlisted keys that level 0
lets pass, level 2 one of the listed keys that level 1 lets pass, and so on
until no key is wrong.  A key is listed if the first level that doesn't hold it
has an odd number (or if it passes all of an odd number of levels).  Since the
levels are built over *all* keys of the corpus, the answer is exact for each of
them; keys that are neither in the corpus nor listed may be answered wrongly.

Keys are 128-bit hashes.  They are dealt by hash into shards of SHARD_KEYS keys
or so, each with a cascade of its own, built in one task from that bounded set.
Shards are sent to the workers in passes of PASS_BYTES at most (one pass for
lists of up to some 50 million keys); a row is read by its own shard's pass only.

Defined results: a null url, or one without ``://``, has an empty host and path
and is judged like any other; no rule fits an empty host.  Repeated rows and
null ids are rows of their own.  An empty table gives an empty result, an empty
list lists nothing.  Other columns never matter, whatever their names.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_only, map_arrow, pick, stored, table

#: (verdict, host, path): the rule fits the host and its subdomains, and paths that start so.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: Words that put an address on the blocklist when they stand alone between
#: non-letters of its host or path (parameter of the query).
LISTED_WORDS = [
    "adserver", "ads", "adult", "bet", "bets", "betting", "casino", "cialis", "escort", "gambling", "keygen", "malware", "payday",
    "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "torrent", "track", "tracker", "viagra", "warez", "xxx",
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = "://([^/?#]*)([^?#]*)"

SHARD_KEYS = 1 << 17
MIN_SHARDS = 64
PASS_BYTES = 64 << 20
#: The first level lets about this share of the listed keys' number of other keys pass.
FIRST_SHARE = 0.5
LAYOUT = "shard int, level int, hashes int, bits long, data binary"


# ------------------------------------------------------------------- levels

def _mixed(h1: np.ndarray, h2: np.ndarray, level: int, i: int) -> np.ndarray:
    """Hash i of a level for keys given as two 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = h1.view(np.uint64) + np.uint64(2 * level + 1) * np.uint64(0x9E3779B97F4A7C15)
        x ^= (h2.view(np.uint64) + np.uint64(i)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Level:
    level: int
    hashes: int
    bits: int
    data: np.ndarray        # uint8, bits / 8

    @classmethod
    def of(cls, level: int, h1: np.ndarray, h2: np.ndarray, share: float) -> Level:
        """Bloom filter of the keys that lets about ``share`` of others pass."""
        hashes = max(1, round(-np.log2(share)))
        bits = max(64, -(-int(np.ceil(len(h1) * hashes / np.log(2))) // 8) * 8)
        mark = np.zeros(bits, bool)
        for i in range(hashes):
            mark[(_mixed(h1, h2, level, i) % np.uint64(bits)).astype(np.int64)] = True
        return cls(level, hashes, bits, np.packbits(mark))

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for i in range(self.hashes):
            at = _mixed(h1, h2, self.level, i) % np.uint64(self.bits)
            out &= (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
        return out


def built_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[Level]:
    """Levels that tell the listed keys from the others, all of them distinct."""
    holds = (h1[listed], h2[listed])
    others = (h1[~listed], h2[~listed])
    levels: list[Level] = []
    while len(holds[0]):
        share = 0.5 if levels else min(0.5, FIRST_SHARE * len(holds[0]) / max(1, len(others[0])))
        new = Level.of(len(levels), *holds, share)
        levels.append(new)
        wrong = new.has(*others)
        holds, others = (others[0][wrong], others[1][wrong]), holds
    return levels


def is_listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The number of levels passed before the first miss is odd."""
    passed, open_ = np.zeros(len(h1), np.int64), np.arange(len(h1))
    for lv in levels:
        open_ = open_[lv.has(h1[open_], h2[open_])]
        passed[open_] += 1
    return passed % 2 == 1


# ------------------------------------------------------------------ cascade

@dataclass
class Cascade:
    """``filters``: one row per shard and level, a table in the shared folder."""
    filters: DataFrame
    shards: int


def key_hashes(key: Column | str) -> list[Column]:
    return [F.xxhash64(F.lit(seed), key).alias(name) for seed, name in ((1, "h1"), (2, "h2"))]


def shard_of(shards: int) -> Column:
    return F.col("h1").bitwiseAND(F.lit(shards - 1)).cast("int").alias("shard")


def build(universe: DataFrame, listed: DataFrame, key: str = "key") -> Cascade:
    """Cascade for the listed keys over all keys that will be asked for; both
    tables may repeat keys, listed keys needn't be in the universe."""
    def hashed(df, flag):
        k = pick(df, key=key).filter("key IS NOT NULL")
        return k.select(*key_hashes("key"), F.lit(flag).alias("listed"))

    keys = stored(hashed(universe, False).unionByName(hashed(listed, True)).groupBy("h1", "h2").agg(F.max("listed").alias("listed")), "url_keys")
    n = keys.count()
    shards = max(MIN_SHARDS, 1 << max(0, int(np.ceil(np.log2(max(1, n) / SHARD_KEYS)))))

    def shard_levels(pdf):
        import pandas as pd

        rows = [(int(pdf["shard"].iloc[0]), lv.level, lv.hashes, lv.bits, lv.data.tobytes())
                for lv in built_levels(pdf["h1"].to_numpy(), pdf["h2"].to_numpy(), pdf["listed"].to_numpy())]
        return pd.DataFrame(rows, columns=["shard", "level", "hashes", "bits", "data"])

    filters = keys.select("h1", "h2", "listed", shard_of(shards)).groupBy("shard").applyInPandas(shard_levels, LAYOUT)
    return Cascade(stored(filters, "url_filters"), shards)


def passes(cascade: Cascade) -> list[tuple[int, int]]:
    """Ranges of shards (first, last) that cover all of them, PASS_BYTES of
    filters each at most (or one shard)."""
    sizes = cascade.filters.groupBy("shard").agg(F.sum(F.octet_length("data")).alias("n")).collect()   # one row per shard
    firsts, room = [0], PASS_BYTES
    for r in sorted(sizes, key=lambda r: r["shard"]):
        if r["n"] > room and r["shard"] > firsts[-1]:
            firsts.append(r["shard"])
            room = PASS_BYTES
        room -= r["n"]
    return [(a, b - 1) for a, b in zip(firsts, [*firsts[1:], cascade.shards])]


def members(cascade: Cascade, df: DataFrame, key: Column, name: str = "listed") -> DataFrame:
    """``df`` with a boolean column: whether the key is listed.  A null key isn't."""
    names, width = df.columns, len(df.columns)
    inner = [f"__{i}" for i in range(width)]
    asked = df.select("*", *key_hashes(key), key.isNotNull()).toDF(*inner, "h1", "h2", "real").select("*", shard_of(cascade.shards))
    schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(inner, df.schema.fields)), T.StructField(name, T.BooleanType())])
    parts = []
    for first, last in passes(cascade):
        rows = cascade.filters.filter(F.col("shard").between(first, last)).collect()        # PASS_BYTES at most
        sent = df.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])

        def run(batches, sent=sent):
            keep_only("urlfilter")
            levels: dict[int, list[Level]] = {}
            for s, level, hashes, bits, data in sorted(sent.value, key=lambda r: r[:2]):
                levels.setdefault(s, []).append(Level(level, hashes, bits, np.frombuffer(data, np.uint8)))
            for b in batches:
                h1, h2, real, shard = (b.column(width + i).to_numpy(zero_copy_only=False) for i in range(4))
                order = np.argsort(shard, kind="stable")
                hit = np.zeros(len(shard), bool)
                for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []:
                    hit[part] = is_listed(levels.get(int(shard[part[0]]), []), h1[part], h2[part])
                yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(hit & real)], schema.names)

        parts.append(map_arrow(asked.filter(F.col("shard").between(first, last)), run, schema))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.toDF(*names, name)


# -------------------------------------------------------------------- rules

def address(url: Column | str) -> tuple[Column, Column]:
    """(host, path) of a url; both empty if it is null or has no ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, ADDRESS, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def first_rule(host: Column, path: Column, rules: list) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits (host and path counted
    together, then the first listed); nulls if there is none."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def judged(df: DataFrame, cascade: Cascade, rules: list = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, listed, verdict: the rule's, else ``block``
    for a listed address and ``allow`` for any other."""
    host, path = address("url")
    rows = pick(df, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    asked = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    out = members(cascade, asked, F.concat("host", "path"))
    return out.select("page_id", "host", "path", "rule", "listed",
                      F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


def listed_by_words(keys: DataFrame, words: list[str] = LISTED_WORDS) -> DataFrame:
    """The keys that hold one of the words between non-letters."""
    own = F.regexp_extract_all(F.translate("key", UPPER, LOWER), F.lit("[a-z]+"), F.lit(0))
    return keys.filter(F.arrays_overlap(own, F.array(*[F.lit(w) for w in words])))


def op11_cascade_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = address("url")
    keys = pick(pages, url="url").select(F.concat(host, path).alias("key"))
    return judged(pages, build(keys, listed_by_words(keys)))


_FITS = "\n".join(f"  WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
                  for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
SQL_OP11 = f"""
WITH a AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{ADDRESS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
                  coalesce(regexp_extract(url, '{ADDRESS}', 2), '') AS path FROM pages),
r AS (SELECT *, CASE
{_FITS} END AS fit,
  list_has_any(regexp_extract_all(translate(host || path, '{UPPER}', '{LOWER}'), '[a-z]+'), {LISTED_WORDS}) AS listed FROM a)
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule, listed,
       coalesce(split_part(fit, ' ', 1), CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict FROM r
"""

QUERIES = {"op11_cascade_filter": op11_cascade_filter}
SQL: dict[str, str] = {"op11_cascade_filter": SQL_OP11}
