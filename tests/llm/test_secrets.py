import math
import random
import time
from collections import Counter

from loglens.llm import secrets


def brute(s, window, least):
    cover = set()
    for i in range(len(s) - window + 1):
        c = Counter(s[i:i + window])
        if -sum(n / window * math.log2(n / window) for n in c.values()) >= least - 1e-9:
            cover.update(range(i, i + window))
    return cover


def test_incremental_entropy_equals_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        s = "".join(rng.choice("abcdef0123456789" if rng.random() < .7 else "aa") for _ in range(rng.randrange(80)))
        got = set()
        for a, b in secrets.hot_windows(s, 20, 3.0):
            got.update(range(a, b))
        assert got == brute(s, 20, 3.0)


def test_patterns():
    kinds = lambda t: [(s["kind"], t[s["start"]:s["end"]]) for s in secrets.spans(t)]
    assert kinds('ké PassWord: "abcdef" x') == [("assign", 'PassWord: "abcdef')]
    assert kinds("token=abc") == [] and kinds("api-key=abcdef") == []
    assert kinds("AKIA" + "A" * 15) == [] and kinds("xAKIA" + "A1" * 8) == [("access", "AKIA" + "A1" * 8)]
    assert kinds("f" * 23) == [] and kinds("g" + "f" * 24 + "g") == [("hex", "f" * 24)]
    both = "secret=" + "0123456789abcdef" * 2
    assert [k for k, _ in kinds(both)] == ["assign", "hex"]
    # 'ſ' and the Kelvin sign are not letters of the pattern
    assert kinds("paſſword=abcdefgh") == [] and kinds("toKen=abcdefgh") == []


def test_entropy_and_allow_list():
    spans = lambda t: [s["kind"] for s in secrets.spans(t)]
    assert spans("wJalrXUtnFEMI7K7MDENGbPxRfiCYq8Zt3") == ["entropy_base64"]
    assert spans("F0E1D2C3B4A5968778695A4B3C2D1E0F") == ["entropy_hex"]
    for clean in ("thequickbrownfoxjumpsoverthelazydog", "0123456789abcdefghijklmnopqrstuvwxyz", "4041894974608795404189", "my-long-file-name-of-2024-report-v2",
                  "https://host/wJalrXUtnFEMI7K7MDENGbPxRfiCYq8Zt3", "wJalrXUtnFEMI7K7MDENGbPxRfiCYq8Zt3@mail.example.com", "wJalrXUtnFEMI7EXAMPLEKEYbPxRfiCYq8"):
        assert spans(clean) == [], clean


def test_exemptions_end_with_the_address():
    key = "wJalrXUtnFEMI7K7MDENGbPxRfiCYq8Zt3"
    found = lambda t: [t[s["start"]:s["end"]] for s in secrets.spans(t)]
    for t in ('{"url":"https://h/v1","k":"%s"}', "mail@host.org,%s", "postgres://user:%s@host/db", "https://%s@host.org/x", "https://h.org/a/b?k=%s&x=1", "https://h.org/a#%s", "www.h.org,%s"):
        assert found(t % key) == [key], t
    assert found(f"{key}.{key[::-1]}.x1") == [key, key[::-1]]
    assert found("z" * 41 + "9") == []
    letters = "wJalrXUtnFEMIKqMDENGbPxRfiCYqZt"
    assert found(letters) == [letters] and found(letters + "42") == [letters + "42"]
    assert found("dummy/" + key) == ["/" + key] and found("my-example-" + key) == ["-" + key]
    for clean in ("https://host.org/" + "a1b2-c3d4/" * 60 + key, "http://host:8080/x@" + key, "getHttpResponseCodeForMessage2", key.lower() + ".host.org", "mailto:" + key + "@host.org"):
        assert found(clean) == [], clean


def test_addresses_in_linear_time():
    for text in ("://" * 100_000, "a://b:=" * 40_000, "a@" * 100_000, "a." * 100_000, "www." * 80_000, "://u:" * 60_000):
        t = time.process_time()
        secrets.spans(text + "wJalrXUtnFEMI7K7MDENGbPxRfiCYq8Zt3")
        assert time.process_time() - t < 6, text[:10]


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    out = secrets.scan(edge_docs)
    assert out.columns == [*edge_docs.columns, "spans"] and out.count() == len(edge_rows)
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "é password=hunter22 " * 20_000), (3, "x")], "doc_id long, text string")
    got = {(r[0], len(r[1])) for r in secrets.found_only(rows).collect()}
    assert got == {(1, 0), (2, 0), (3, 20_000), (3, 0)}
    assert secrets.found_only(no_docs).collect() == []


def test_random_keys_are_found_whole():
    rng = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for n in (20, 22, 24, 28, 32, 40, 64):
        found = 0
        for _ in range(500):
            key = "".join(rng.choice(letters) for _ in range(n))
            t = f'the key is "{key}", he said'
            found += key in [t[s["start"]:s["end"]] for s in secrets.spans(t)]
        assert found >= 490, (n, found)
