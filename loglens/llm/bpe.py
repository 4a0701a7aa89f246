"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

``encode(df)`` appends ids (and, on request, byte offsets of every token) to
the rows of any DataFrame; ``decode(df)`` reverses them.  Each worker builds
the tokenizer once from the public rank file and feeds it the distinct new
pieces of Arrow batches in slices of bounded size, so memory depends on the
slice, the piece cache and the longest single text only.

Rank file → tokenizer: the vocabulary maps every byte to a printable character
(the usual byte table, a rule, not data); merges are all splits of a token
into two known tokens, in rank order; a pre-token that is itself in the
vocabulary is taken whole (``ignore_merges``), as the rank encoder does.

Defined results: a null or empty text has no ids (``[]``) and decodes to
empty bytes; null ids decode to empty bytes; ids cut inside a character give
the exact bytes, and ``decode_text`` replaces incomplete ones by U+FFFD only
where the cut really splits a character; unknown ids raise ``KeyError``.
Repeated rows are encoded alike; other columns pass through untouched.
"""
from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import WORKER_CACHES, keep_only, map_arrow, pick, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The code points with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts are cut and encoded in slices of at most this many code points (or one text).
SLICE_CHARS = 1 << 19
#: Pieces a worker keeps the ids of (about 200 bytes each).
CACHE_PIECES = 250_000


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def byte_table() -> list[str]:
    """byte → character: printable Latin-1 bytes stand for themselves, the
    others get the code points from 256 on, in byte order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class PieceCoder:
    """Ids of texts.  A text is cut before every run of white space; no match
    of the pattern reaches over such a cut (its matches may start with white
    space but never go on into it), so pieces can be encoded one by one.  The
    library splits by the pattern and merges those pieces that are not in the
    cache, a slice's new ones in one batch, and the cached ids are strung
    together.  The cache is emptied when it holds CACHE_PIECES pieces, so its
    size never follows the corpus."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks, to_char = read_ranks(path), byte_table()
        name = {t: "".join(to_char[b] for b in t) for t in ranks}
        merges = []
        for t in sorted(ranks, key=ranks.get):
            halves = [(t[:i], t[i:]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
            merges += [(name[a], name[b]) for a, b in sorted(halves, key=lambda h: (ranks[h[0]], ranks[h[1]]))]
        self.tok = Tokenizer(models.BPE({name[t]: r for t, r in ranks.items()}, merges, cache_capacity=0, ignore_merges=True))
        self.tok.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.pieces = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
        self.cache: dict[str, tuple[int, ...]] = {}
        from_char = {c: b for b, c in enumerate(to_char)}
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, r in ranks.items():
            self.bytes[r] = bytes(from_char[c] for c in name[t])   # through the reversed byte table

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        for a, b in slices(texts):
            cut = [self.pieces(t) if t else [] for t in texts[a:b]]
            new = list(set(chain.from_iterable(cut)).difference(self.cache))
            if len(self.cache) + len(new) > CACHE_PIECES:
                self.cache.clear()
                new = list(set(chain.from_iterable(cut)))
            for i in range(0, len(new), 4096):
                part = new[i:i + 4096]
                self.cache.update(zip(part, (tuple(e.ids) for e in self.tok.encode_batch_fast(part, add_special_tokens=False)), strict=True))
            for pieces in cut:
                yield list(chain.from_iterable(map(self.cache.__getitem__, pieces)))


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> PieceCoder:
    """One coder per rank file and Python worker."""
    keep_only("bpe")
    return PieceCoder(path, pattern)


WORKER_CACHES["bpe"] = coder.cache_clear


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most SLICE_CHARS code points together, or of one row."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def byte_offsets(ids: list[int], table_: list[bytes]) -> list[int]:
    """End byte of each token in the UTF-8 text (its start is the end before)."""
    ends, at = [], 0
    for i in ids:
        at += len(table_[i])
        ends.append(at)
    return ends


def decoded_bytes(ids, table_: list[bytes]) -> bytes:
    return b"".join([table_[i] for i in ids]) if ids is not None else b""


def decode_stream(pieces: Iterator[bytes]) -> Iterator[str]:
    """Text of consecutive byte pieces; a character split between two pieces
    is held back until its last byte has come."""
    import codecs

    d = codecs.getincrementaldecoder("utf-8")("replace")
    for p in pieces:
        yield d.decode(p)
    yield d.decode(b"", final=True)


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", ends_col: str | None = None,
           ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with ``ids_col`` (array<int>) and, if named, ``ends_col``: the end
    byte of each token."""
    path, pat = ranks_path or default_ranks(), pattern or default_pattern()
    at = df.columns.index(text_col)
    plain = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if ends_col:
        fields.append(T.StructField("ends", T.ArrayType(T.IntegerType())))

    def run(batches):
        code = coder(path, pat)
        for b in batches:
            ids = list(code.encode(b.column(at).to_pylist()))
            cols = [pa.array(ids, pa.list_(pa.int32()))]
            if ends_col:
                cols.append(pa.array([byte_offsets(x, code.bytes) for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *[f.name for f in fields]])

    out = map_arrow(plain, run, T.StructType([*plain.schema.fields, *fields]))
    return out.toDF(*df.columns, ids_col, *([ends_col] if ends_col else []))


def decode(df: DataFrame, ids_col: str = "ids", bytes_col: str = "bytes", ranks_path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``df`` with ``bytes_col``: the exact bytes of the ids."""
    path, pat = ranks_path or default_ranks(), pattern or default_pattern()
    at = df.columns.index(ids_col)
    plain = df.toDF(*[f"__{i}" for i in range(len(df.columns))])

    def run(batches):
        table_ = coder(path, pat).bytes
        for b in batches:
            out = pa.array([decoded_bytes(x, table_) for x in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, "bytes"])

    out = map_arrow(plain, run, T.StructType([*plain.schema.fields, T.StructField("bytes", T.BinaryType())]))
    return out.toDF(*df.columns, bytes_col)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
               ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode and decode in one pass over the texts: id, n_tokens, ids_sha256,
    decoded_sha256 (and ids).  Only digests leave the task, so nothing larger
    than a slice of texts is ever held."""
    path, pat = ranks_path or default_ranks(), pattern or default_pattern()
    rows = pick(df, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
                           *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else [])])

    def run(batches):
        code = coder(path, pat)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in batches:
            n, hi, hd, kept = [], [], [], []
            for ids in code.encode(b.column(1).to_pylist()):
                n.append(len(ids))
                hi.append(sha(",".join(map(str, ids)).encode()))
                hd.append(sha(decoded_bytes(ids, code.bytes)))
                if keep_ids:
                    kept.append(ids)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.string()), pa.array(hd, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.list_(pa.int32()))] * keep_ids, schema.names)

    return map_arrow(rows, run, schema)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
SQL: dict[str, str] = {}
