"""Backtracking BPE against the tiktoken library."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from notchline.llm import bpe_backtrack as B

FILES = ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")
ODD = ["", " ", "a", "  two  spaces\n\n end  ", "don't we'll 'S", "naïve Größe ñandú ¡olé!", "日本語のテキスト 中文", "emoji 👩‍👩‍👧 🇫🇷", "á ​ zero﻿", "١٢٣ ೧೨ Ⅷ ½", "\x00\x1c\x85\xa0 x", "ab" * 400, "a" * 1000, "🦊" * 50, "x" + " " * 300 + "y", "𐍈𝔘𝔫𝔦", "\U0001fae8 Ᲊ Ꟛ"]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    ranks = B.load_ranks(P.path(request.param))
    return B.Codec.of(P.path(request.param), P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), request.param


def test_pieces_equal_the_library(both):
    codec, own, _ = both
    rng = np.random.default_rng(5)
    for text in ODD:
        assert codec.whole(text) == own.encode_ordinary(text), text
    for _ in range(3000):
        raw = rng.choice(list("abcdefghiéñtßnös th"), rng.integers(1, 40))
        text = "".join(raw)
        assert codec.whole(text) == own.encode_ordinary(text), text
    for _ in range(2000):  # any bytes as one piece
        piece = bytes(rng.integers(0, 256, rng.integers(1, 25), dtype=np.uint8))
        assert codec.merges.encode(piece) == own._core_bpe.encode_single_piece(piece)


def test_documents(spark, both):
    codec, own, name = both
    path = P.path(name)
    rows = [(i, t, "c") for i, t in enumerate(ODD * 2)] + [(100, None, "c"), (None, "null id", "c"), (7, "a", "c"), (101, "Long tëxt with words, 12 of them. " * 4000, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = B.bpe_digests(df, path, P.PATTERN).collect()
    want = []
    for d, t, _ in rows:
        ids = own.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    enc = B.encode_bpe(df, path, P.PATTERN)
    back = sorted(((r.id is None, r.id or 0, bytes(r.data).decode()) for r in B.decode_bpe(enc, path, P.PATTERN).collect()))
    assert back == sorted((d is None, d or 0, t or "") for d, t, _ in rows)


def test_store_may_be_emptied_at_any_time(both):
    codec, own, _ = both
    store = B.Store(codec.store.encode)
    store.limit = 5
    for words in (["a", " the", "zzz"], ["qq", "a", " xx", "y"], ["a"]):
        n = store.numbers(words)
        assert B.gather(store.pool, store.start[n], store.size[n]).tolist() == [i for w in words for i in own.encode_ordinary(w)]


def test_empty_table(spark, both):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.bpe_digests(df, P.path(both[2]), P.PATTERN).collect() == []
