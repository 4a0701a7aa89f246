import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglens.llm import urlfilter as U

PAGES = "page_id long, url string, html string, URL string, host string, h1 int, __0 string"


def plain_address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def plain_rule(host, path, rules):
    fit = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0])) if fit else (None, None)


def test_levels_are_exact_for_every_key():
    rng = np.random.default_rng(1)
    for n, share in ((1, 1.0), (2, 0.5), (5000, 0.01), (5000, 0.9), (300, 0.0), (200_000, 0.05)):
        h1, h2 = rng.integers(-2**63, 2**63, (2, n))
        listed = rng.random(n) < share
        levels = U.built_levels(h1, h2, listed)
        assert (U.is_listed(levels, h1, h2) == listed).all()
    assert len(levels) > 3 and sum(lv.bits for lv in levels) < 12 * listed.sum() + 64 * len(levels)   # far less than a bit a key


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    hosts = ["a.example.org", "example.org", "Example.ORG", "notexample.org", "x.com", "com", "org", "casino.example.net", "é.net", "u@h:80"]
    tails = ["", "/", "/es/1", "/en/12", "/en/2", "/fr/x?y#z", "/de/", "#top", "?q=://b", "/ads/1", "/de/ads", "//", "/a b\nc"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{t}" for h in hosts for t in tails]
    urls += [None, "", "no address", "://", "http://", "http://x.com/" + "long/" * 40_000, "x.com/de/", urls[5], urls[5]]
    return [(n if n % 7 else None, u, "h", "U", "host", n, "zero") for n, u in enumerate(urls)]


def test_judged_against_brute_force(spark, rows, monkeypatch):
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    host, path = U.address("url")
    keys = U.pick(pages, url="url").select(F.concat(host, path).alias("key"))
    want = []
    for i, u, *_ in rows:
        h, p = plain_address(u)
        rule, verdict = plain_rule(h, p, U.RULES)
        words = "".join(c if c.isascii() and c.isalpha() else " " for c in (h + p).lower()).split()
        listed = not set(words).isdisjoint(U.LISTED_WORDS)
        want.append((i, h, p, rule, listed, verdict or ("block" if listed else "allow")))
    for size in (U.PASS_BYTES, 20):             # one pass, many passes
        monkeypatch.setattr(U, "PASS_BYTES", size)
        cascade = U.build(keys, U.listed_by_words(keys))
        assert (len(U.passes(cascade)) > 1) == (size == 20)
        got = U.judged(pages, cascade)
        assert got.columns == ["page_id", "host", "path", "rule", "listed", "verdict"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_shards_and_listed_keys_outside_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(U, "SHARD_KEYS", 40)
    all_ = spark.range(8000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = all_.filter("key like '%7'").unionByName(spark.createDataFrame([("elsewhere",), (None,), ("k7",)], "key string"))
    cascade = U.build(all_, listed)
    assert cascade.shards == 256
    asked = all_.unionByName(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    got = {r.key: r.listed for r in U.members(cascade, asked, F.col("key")).collect()}
    assert got == {None: False, "elsewhere": True, **{f"k{i}": i % 10 == 7 for i in range(8000)}}


def test_empty_tables(spark, rows):
    none = spark.createDataFrame([], PAGES)
    keys = none.select(F.lit("").alias("key"))
    assert U.judged(none, U.build(keys, keys)).collect() == []
    pages = spark.createDataFrame(rows[:5], PAGES)
    assert not any(r.listed for r in U.judged(pages, U.build(keys, keys)).collect())
