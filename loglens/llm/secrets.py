"""Secret scan: fixed patterns plus sliding-window Shannon entropy.

``scan(df)`` appends all spans of every whole text.  Two sources of spans:

* patterns (kinds ``assign``, ``access``, ``hex``), leftmost and
  non-overlapping per kind;
* entropy (kinds ``entropy_hex``, ``entropy_base64``): candidate strings are
  runs of the class's characters; a window slides over each candidate and its
  Shannon entropy is kept by incremental counts (one character in, one out).
  A candidate with a window at or above the threshold is one span.  Chance alone
  takes bits from a short key, and a long one has more windows to show them, so
  the threshold rises with the candidate's length up to LONG.  Hosts, the
  path segments of URLs, mail addresses and segments with a placeholder are
  cut out of a candidate; what is left goes if it is on the allow-list (plain
  words, numbers, counting sequences).  User info, query values and fragments
  of a URL are checked like other text.  Spans inside a pattern span are dropped.

The allow-list never touches pattern spans.  Offsets are code points, the end
exclusive.  Defined results: a null or empty text has no spans (``[]``);
repeated rows are scanned alike; other columns pass through untouched.  A text
is handled whole, one at a time; memory is bounded by the Arrow batch.
"""
from __future__ import annotations

import math
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, pick, table

#: Kinds in the order of ties at one start.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy_hex", "entropy_base64")

#: The patterns of the contract, their minimum lengths built in
#: (a run of hex digits is maximal, so ``+`` with a minimum is ``{24,}``).
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_MIN = 6

#: kind, characters of a candidate, window, least bits a character in a candidate of one window and of LONG.
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9A-Fa-f]{20,}"), 20, 2.9, 3.0),
    ("entropy_base64", re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}"), 20, 3.6, 3.9),
)
LONG = 40
#: Anything shorter can hold no candidate.
ANY_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20}")

#: Allow-list, matched against what is left of a candidate.
ALLOWED = tuple(re.compile(p) for p in (
    r"[0-9_+/-]+=*",                                     # numbers, dates, phone numbers
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # UUID
))
#: Words joined by separators, without digits but up to four at a word's end.
JOINED = re.compile(r"[/_-]*(?:[A-Za-z]+[0-9]{0,4}[/_-]+)*(?:[A-Za-z]+[0-9]{0,4})?=*")
LETTERS, CASE_PART, CONSONANTS = re.compile(r"[A-Za-z]+"), re.compile(r"[A-Z]?[a-z]+|[A-Z]+"), re.compile(r"[b-df-hj-np-tv-xz]{6}", re.I)
#: From so many letters on, parts of one case have CASE_LETTERS on average in words.
CASE_FROM, CASE_LETTERS = 6, 2.5
#: From so many letters on, words have vowels, a fourth at least, and no six consonants in a row.
VOWELS_FROM, VOWELS = 16, 0.25
#: Placeholders, matched against a segment of a candidate.
SEGMENT, PLACEHOLDER = re.compile(r"[A-Za-z0-9]+"), re.compile(r"(?i:example|placeholder|changeme|dummy|xxxxx)")
#: Sequences that have high entropy and are no secrets.
COUNTING = ("0123456789abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789",
            "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
#: Addresses.  A URL: user info (checked like other text), then host, port and
#: path up to white space, a quote, a comma, '?', '&', '=' or the like.
URL = re.compile(r"""(?P<start>://|(?<![A-Za-z0-9])www\.)(?P<user>[^\s/@"'`<>,?#]{0,512}@|[^\s/@:"'`<>,?#]{0,512}:(?!\d+/)[^\s@"'`<>,?#]{0,512}@)?
    (?P<rest>[^\s/?\#"'`<>,;&=@:|(){}\[\]\\]*(?::\d{1,5}(?![^\s/?\#"'`<>,;&=|(){}\[\]\\]))?(?:/[^\s?\#"'`<>,;&=|(){}\[\]\\]*)?)""", re.X)
MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9_+=-])")
#: A bare host or file name: lower-case labels, letters at the end.
HOST = re.compile(r"(?<![A-Za-z0-9._/+=-])(?:[a-z0-9][a-z0-9-]{0,62}\.)+[a-z]{2,24}(?![A-Za-z0-9_+=-]|\.[A-Za-z0-9])")

SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType())]))


def wordlike(s: str) -> bool:
    """A run of letters that reads like words by its cases and vowels."""
    if len(s) >= CASE_FROM and len(s) < CASE_LETTERS * len(CASE_PART.findall(s)):
        return False
    return len(s) < VOWELS_FROM or (sum(c in "aeiouyAEIOUY" for c in s) >= VOWELS * len(s) and not CONSONANTS.search(s))


def allowed(s: str) -> bool:
    if any(p.fullmatch(s) for p in ALLOWED) or JOINED.fullmatch(s) and all(map(wordlike, LETTERS.findall(s))):
        return True
    core = s.rstrip("=")
    return any(core in c or core.lower() in c or core in c[::-1] for c in COUNTING)


def addresses(text: str) -> list[tuple[int, int]]:
    """Merged ranges of hosts, paths of URLs and mail addresses, in order."""
    found, users = [], []
    if "://" in text or "www." in text:
        for m in URL.finditer(text):
            found.append(m.span("start"))
            found.append(m.span("rest"))
            if m["user"]:
                users.append(m.span("user"))
    if "@" in text:
        ends = [b for _, b in users]
        for m in MAIL.finditer(text):
            i = bisect_right(ends, m.start())
            if i == len(users) or users[i][0] >= m.end():
                found.append(m.span())
    if "." in text:
        found += [m.span() for m in HOST.finditer(text)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        elif a < b:
            out.append((a, b))
    return out


def pieces(text: str, start: int, end: int, exempt: list[tuple[int, int]], ends: list[int]) -> list[tuple[int, int]]:
    """What is left of a candidate without addresses and placeholders."""
    cuts = []
    for i in range(bisect_right(ends, start), len(exempt)):
        if exempt[i][0] >= end:
            break
        cuts.append(exempt[i])
    if PLACEHOLDER.search(text, start, end):
        cuts = sorted(cuts + [m.span() for m in SEGMENT.finditer(text, start, end) if PLACEHOLDER.search(m.group())])
    out = []
    for a, b in cuts:
        if a > start:
            out.append((start, a))
        start = max(start, b)
    return [*out, (start, end)] if start < end else out


def hot_windows(s: str, window: int, least: float) -> list[tuple[int, int]]:
    """Merged ranges covered by windows of at least ``least`` bits a character.

    entropy * window = window*log2(window) - sum(c*log2(c)); the sum changes
    by two terms when the window moves by one character."""
    if len(s) < window:
        return []
    f = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]   # a character comes in before one goes
    most = window * math.log2(window) - least * window + 1e-9   # of the sum
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += f[c + 1] - f[c]
        if i >= window:
            old = s[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += f[c - 1] - f[c]
        if i >= window - 1 and total <= most:
            a = i - window + 1
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((a, i + 1))
    return out


def least_bits(n: int, window: int, short: float, long: float) -> float:
    """Threshold for a candidate of n characters."""
    return short + (long - short) * min(1.0, max(0, n - window) / (LONG - window))


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the contract's patterns."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def entropy_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = []
    taken = [(a, b) for a, _, b in known]
    exempt = addresses(text)
    ends = [b for _, b in exempt]
    for kind, run, window, short, long in CLASSES:
        for m in run.finditer(text):
            for a, b in pieces(text, *m.span(), exempt, ends):
                if b - a < window or allowed(text[a:b]) or any(x <= a and b <= y for x, y in taken):
                    continue
                if hot_windows(text[a:b], window, least_bits(b - a, window, short, long)):
                    out.append((a, KINDS.index(kind), b))
                    taken.append((a, b))
    return out


def spans(text: str | None) -> list[dict]:
    if not text:
        return []
    found = pattern_spans(text)
    if ANY_CANDIDATE.search(text):
        found = found + entropy_spans(text, found)
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(found)]


def scan(df: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``df`` with ``out_col``: array of (kind, start, end)."""
    at = df.columns.index(text_col)
    plain = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    schema = T.StructType([*plain.schema.fields, T.StructField("spans", SPAN)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            found = pa.array([spans(t) for t in b.column(at).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*b.columns, found], [*b.schema.names, "spans"])

    return map_arrow(plain, run, schema).toDF(*df.columns, out_col)


def listed(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans_: Column, kind: str) -> Column:
    return F.size(F.filter(spans_, lambda s: s["kind"] == kind)).cast("long")


def found_only(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans; texts don't come back from the workers."""
    rows = pick(df, doc_id=id_col, text=text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("spans", SPAN)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([spans(t) for t in b.column(1).to_pylist()], arrow)], ["doc_id", "spans"])

    return map_arrow(rows, run, schema)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("spans")
    base = F.filter(s, lambda x: x["kind"].isin(*BASE_KINDS))
    return found_only(table(spark, sf_dir, "documents")).select(
        "doc_id", *[counted(s, k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(s).alias("spans"),
        F.size(F.filter(s, lambda x: ~x["kind"].isin(*BASE_KINDS))).cast("long").alias("n_entropy"))


QUERIES = {"op3_secret_scan": op3_secret_scan}
SQL: dict[str, str] = {}
