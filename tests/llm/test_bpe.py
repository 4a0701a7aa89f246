import hashlib
import random

import pytest
import tiktoken

from loglens.llm import bpe


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=bpe.read_ranks(bpe.default_ranks()), special_tokens={})


def test_ids_equal_the_rank_encoder(reference):
    rng = random.Random(1)
    alphabet = "ab c'S  s\n\t\x1c\x1f\x85\xa0​ é😀中文¡12,.-_=aaaa\x00"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0xd7ff), rng.randint(0xe000, 0x10ffff)])) for _ in range(40)) for _ in range(300)]
    coder = bpe.coder(bpe.default_ranks(), bpe.default_pattern())
    assert list(coder.encode(texts)) == [reference.encode_ordinary(t) for t in texts]


def test_cache_limit_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    monkeypatch.setattr(bpe, "SLICE_CHARS", 20)
    texts = ["some words here", "some other words", None, "", "words words", "a much longer text of words than a slice holds"]
    coder = bpe.PieceCoder(bpe.default_ranks(), bpe.default_pattern())
    assert list(coder.encode(texts)) == [reference.encode_ordinary(t or "") for t in texts]


def test_round_trip_of_edge_rows(edge_docs, edge_rows, no_docs, reference):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(edge_docs).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, *_ in edge_rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i is None, i or 0, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want)
    assert bpe.round_trip(no_docs).collect() == []


def test_encode_decode_keep_columns_and_offsets(edge_docs, edge_rows):
    out = bpe.decode(bpe.encode(edge_docs, ends_col="ends"))
    assert out.columns == [*edge_docs.columns, "ids", "ends", "bytes"]
    for r in out.collect():
        text = (r[1] or "").encode()
        assert bytes(r[-1]) == text and (r[-2][-1] if r[-2] else 0) == len(text) and len(r[-2]) == len(r[-3])


def test_split_characters(spark):
    coder = bpe.coder(bpe.default_ranks(), bpe.default_pattern())
    [ids] = coder.encode(["naïve 😀"])
    pieces = [coder.bytes[i] for i in ids]
    assert "".join(bpe.decode_stream(iter(pieces))) == "naïve 😀"
    assert "".join(bpe.decode_stream(iter(["😀".encode()[:2]]))) == "�"
    assert bpe.decoded_bytes(None, coder.bytes) == b""
