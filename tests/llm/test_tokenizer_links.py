"""Groups, links and counts against a plain version over whole texts."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from notchline.llm import tokenizer_links as L

from ..conftest import SF_SMALL

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a", " a", "a ", "two  spaces\n\n end  ", "tab\t \n  x \n\n y", "don't we'll 'S", "a▁b", "▁", "naïve Größe ñandú ¡olé!", "日本語 中文", "👩‍👩‍👧 🇫🇷", "a     b  c", "x <|endoftext|> y<s> </s> <0x41>", "\x00\x1c\x85 x", "ſ ﬁ ① Ⅷ", "ab" * 3000, "x" + " " * 300 + "y", "Same words same words same words. " * 500]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    of = {c: x for x, c in enumerate(L.byte_alphabet())}

    def one(text):
        if not text:
            return [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return [], [], []
        spans = []
        for ids, raw in ((ids_a, raw_a), (ids_b, raw_b)):
            at, out = 0, []
            for i, x in zip(ids, raw, strict=True):
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        return *spans, [(x, y) for s, e, x in spans[0] for s2, e2, y in spans[1] if s < e2 and s2 < e] if len(spans[0]) < 2000 else swept(*spans)

    def swept(xs, ys):
        out, j = [], 0
        for s, e, x in xs:
            while ys[j][1] <= s:
                j += 1
            k = j
            while k < len(ys) and ys[k][0] < e:
                out.append((x, ys[k][2]))
                k += 1
        return out

    def groups(xs, ys):
        ends = sorted({e for _, e, _ in xs} & {e for _, e, _ in ys})
        at, out = 0, []
        for cut in ends:
            out.append("|".join(",".join(str(i) for s, e, i in z if at < e <= cut) for z in (xs, ys)))
            at = cut
        return out

    def run(rows):
        found = [one(t) for _, t in rows]
        count = Counter(p for _, _, links in found for p in set(links))
        top = {}
        for (x, _), n in count.items():
            top[x] = max(top.get(x, 0), n)
        out = []
        for (i, _), (xs, ys, links) in zip(rows, found, strict=True):
            g = groups(xs, ys) if len(xs) < 2500 else None
            out.append((i, len(xs), len(ys), None if g is None else len(g), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), None if g is None else hashlib.sha256(";".join(g).encode()).hexdigest() if g else ""))
        return out

    return run


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *(r[k] for k in (1, 2, 4, 5, 6)))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert all(y is None or x == y for x, y in zip(g, w, strict=True)), (g, w)


def test_odd_texts(spark, plain):
    rows = [(i, t) for i, t in enumerate(ODD * 2)] + [(None, "null id"), (3, "a")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, row int, pairs string").repartition(5)
    compare(L.tokenizer_links(df, A, B).collect(), plain(rows))


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_documents_with_and_without_broadcast(spark, plain, monkeypatch, bound):
    monkeypatch.setattr(L, "BROADCAST", bound)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    compare(L.tokenizer_links(docs, A, B).collect(), plain([tuple(r) for r in docs.collect()]))


def test_forgetful_worker(spark):
    both = L.Tokenizers(A, B)
    texts = [f" word{i} über-{i}" for i in range(40_000)]
    first = both.counts[both.numbers(texts[:100])].copy()
    both.held = L.REMEMBERED + 1
    both.numbers(texts[100:])
    assert texts[0] not in both.at and (both.counts[both.numbers(texts[:100])] == first).all()


def test_empty_table(spark):
    assert L.tokenizer_links(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
