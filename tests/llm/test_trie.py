import hashlib
import random
import re
import zlib
from collections import defaultdict

from loglens.llm import trie as R

SCHEMA = "conv_id long, turn long, role string, text string, TEXT string, c long, depth int, p1 string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "T", 1, 2, "p") for r in rows], SCHEMA).repartition(3)


def brute(rows, family=20, head=4):
    """Node rows by walking every conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            what = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, what, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    conv = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % head
        conv[c] = tuple(own.get(c - c % family, [])[:h] + t[h:])
    nodes = defaultdict(list)
    for c, t in conv.items():
        for d in range(len(t) + 1):
            nodes[t[:d]].append(c)
    kids = defaultdict(int)
    for s in nodes:
        if s:
            kids[s[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, m in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(m) - 1) * words
    ends = lambda s, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if conv[c] == s).encode()).hexdigest()
    return [(min(m), len(s), min(nodes[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s], ends(s, m)) for s, m in nodes.items()]


def same(spark, rows, **kw):
    got = R.conversation_trie(frame(spark, rows), **kw)
    assert got.columns == NAMES
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows, **kw)))


def many(seed, n, pool=3, longest=6):
    """Conversations of few different turns: many copies, prefixes, branches."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        turns = rng.sample(range(50), rng.randrange(1, longest))
        rows += [(c, t, rng.choice(["user", "bot"]) if i % 2 else "user", f"say {'x ' * rng.randrange(pool)}{rng.randrange(pool)}") for i, t in enumerate(sorted(turns))]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    same(spark, many(1, 300))
    same(spark, many(2, 60, pool=2, longest=10), family=5, head=3)


def test_small_blocks_and_spans(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 3)      # running sums over many blocks
    monkeypatch.setattr(R, "ID_SPAN", 4)    # end lists over many texts
    same(spark, many(3, 200, pool=1, longest=30))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 16)
    rows = [(0, None, "user", "first"), (0, 3, None, "a b"), (0, 3, "bot", None), (0, -5, "u", ""), (0, 3, "bot", None),     # nulls, ties, repeats
            (20, 0, "user", "first"), (21, 1, "x", "y"), (22, 1, "x", "y"), (41, 2, "x", " \t\n"), (60, 5, "x", "\x85 é"),
            (None, 1, "user", "nobody's"), (2**62, 1, "u", "word " * 50_000), (1000003, 1, "us", "er1:x"), (1000004, 1, "user", "1:x")]
    rows += [(500 + i, t, "user", "same") for i in range(60) for t in range(4)]     # copies
    rows += [(700, t, "user", f"turn {t}") for t in range(120)]                     # one long conversation
    same(spark, rows)


def test_shared_heads_can_leave_no_turn(spark):
    short = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4][:30]
    same(spark, [(c, 0, "user", "only turn") for c in short])
    same(spark, [(short[0], 0, "user", "only turn")])


def test_empty_table(spark):
    same(spark, [])
    same(spark, [(None, 1, "user", "x")])
