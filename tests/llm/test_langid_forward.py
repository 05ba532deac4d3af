"""Segmentation sums and training against plain enumeration; held-out accuracy."""

import itertools
import math

import numpy as np
import public_tokenizers as P
import pytest

from notchline.llm import langid_forward as L

from ..conftest import SF_SMALL

PIECES = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), "▁", "a", "b", "c", "ab", "▁a", "bc", "abc", "▁ab", "aa"]


def cuts(word):
    """All segmentations of U+2581 + word as lists of piece numbers."""
    text, at = "▁" + word, {p: i for i, p in enumerate(PIECES)}

    def rest(s):
        if s == len(text):
            yield []
        for e in range(s + 1, len(text) + 1):
            if text[s:e] in at and not text[s:e].startswith("<"):
                for more in rest(e):
                    yield [at[text[s:e]], *more]
        if text[s : s + 1] and text[s] not in at:
            for more in rest(s + 1):
                yield [*(1 + x for x in text[s].encode()), *more]

    return list(rest(0))


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(3)
    logp = np.log(rng.dirichlet(np.ones(len(PIECES)), 2).T)
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abc", repeat=n)] + ["é", "aé日b", "zz", "a" * 12]
    return L.Pieces(PIECES), logp, words


def test_forward_sums_all_segmentations(small):
    pieces, logp, words = small
    lattice = pieces.lattice(words)
    got = lattice.forward(lattice.weights(logp))[lattice.last]
    back = lattice.backward(lattice.weights(logp))[lattice.first]
    for i, w in enumerate(words):
        for k in (0, 1):
            want = math.log(sum(math.exp(sum(logp[p, k] for p in cut)) for cut in cuts(w)))
            assert got[i, k] == pytest.approx(want, abs=1e-9) and back[i, k] == pytest.approx(want, abs=1e-9)


def test_expected_counts(small):
    pieces, logp, words = small
    lang, times = np.arange(len(words)) % 2, np.arange(len(words)) % 3 + 1.0
    want = np.zeros((len(PIECES), 2))
    for i, w in enumerate(words):
        ways = cuts(w)
        p = np.array([math.exp(sum(logp[x, lang[i]] for x in cut)) for cut in ways])
        for share, cut in zip(p / p.sum(), ways, strict=True):
            for x in cut:
                want[x, lang[i]] += share * times[i]
    got = np.zeros_like(want)
    c, piece, n = pieces.lattice(words).expected(logp, lang, times)
    np.add.at(got, (piece, c), n)
    assert np.allclose(got, want)


def test_long_words_do_not_underflow(small):
    pieces, logp, _ = small
    lattice = pieces.lattice(["abc" * 5000, "a"])
    assert np.isfinite(lattice.forward(lattice.weights(logp))[lattice.last]).all()


def test_held_out_accuracy_and_odd_rows(spark):
    vocabulary = P.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = L.train(docs.where(~L.held_out(docs.doc_id)), vocabulary)
    got = L.predict_languages(docs, model, vocabulary).join(docs.select(docs.doc_id.alias("id"), "lang"), "id").where(L.held_out(L.F.col("id"))).collect()
    assert len(got) > 20 and sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    text = docs.where("lang = 'de' and n_chars > 300").first().text
    odd = [(1, None), (2, ""), (3, " 12 %$ \n"), (4, text * 300), (4, text * 300), (None, text), (6, text.upper()), (7, "日本語"), (8, "x")]
    df = spark.createDataFrame([(i, t, "q", 1.0) for i, t in odd], "doc_id long, text string, lang string, score double")
    out = {(r.id, r.n_words): r for r in L.predict_languages(df, model, vocabulary).collect()}
    assert L.predict_languages(df, model, vocabulary).count() == len(odd)
    assert [(r.lang_pred, r.score) for k, r in out.items() if k[1] == 0] == [("und", 0.0)] * 3
    assert {r.lang_pred for k, r in out.items() if k[0] in (4, None, 6)} == {"de"}
    assert all(r.lang_pred in model.langs for k, r in out.items() if k[1])
    # inputs other than the text do not count
    again = {(r.id, r.n_words): r for r in L.predict_languages(df.drop("lang", "score"), model, vocabulary).collect()}
    assert again == out


def test_training_without_rows(spark):
    vocabulary = P.path("piece_bpe_32k.model")
    none = spark.createDataFrame([(1, "a b", None), (2, None, None)], "doc_id long, text string, lang string")
    model = L.train(none, vocabulary)
    assert [(r.lang_pred, r.score) for r in L.predict_languages(none, model, vocabulary).collect()] == [("und", 0.0)] * 2
    empty = L.train(spark.createDataFrame([(1, None, "en")], none.schema), vocabulary)
    assert [r.lang_pred for r in L.predict_languages(none, empty, vocabulary).orderBy("id").collect()] == ["en", "und"]
    assert L.predict_languages(none.limit(0), empty, vocabulary).count() == 0


def test_every_round_raises_the_likelihood(spark):
    vocabulary = P.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("lang = 'fr'")
    words = [r[0] for r in docs.select(L.F.explode(L.words_of(docs.text))).distinct().limit(500).collect()]
    lattice = L.Pieces.of(vocabulary).lattice(words)
    logs = [L.train(docs, vocabulary, rounds=k).logp for k in (0, 1, 3)]
    sums = [lattice.forward(lattice.weights(x))[lattice.last].sum() for x in logs]
    assert sums[0] < sums[1] < sums[2]
