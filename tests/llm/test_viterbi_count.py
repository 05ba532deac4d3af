"""Count-only Viterbi against the Unigram model of the tokenizers library."""

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer, models

from notchline.llm import viterbi_count as V

ODD = ["", " ", "a", "  two  spaces\n\n end  ", "naïve Größe ñandú", "日本語のテキスト 中文", "emoji 👩‍👩‍👧", "<s> <0x0A> </s> <unk>", "\x00\x85\xa0 x", "ab" * 300, "a" * 500, "🦊" * 20, "x" + " " * 70 + "y", "▁ ▁▁x"]


@pytest.fixture(scope="module")
def library():
    vocab = V.load_vocabulary(P.path("piece_bpe_32k.model"))
    return Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))


def count(library, text):
    return len(library.encode(V.SPACE + text.replace(" ", V.SPACE)).ids) if text else 0


def test_counts_equal_the_library(spark, library):
    rng = np.random.default_rng(8)
    texts = ODD + ["".join(rng.choice(list("abcdeé ntßsth,.\n"), rng.integers(1, 200))) for _ in range(800)]
    texts.append(" ".join("".join(rng.choice(list("etaoinsh"), rng.integers(1, 9))) for _ in range(20000)))
    rows = [(i, t, 1, 2.0) for i, t in enumerate(texts)] + [(-1, None, 1, 2.0), (0, "a", 1, 2.0), (None, "x y", 1, 2.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces int, score double")
    got = sorted((r.id is None, r.id or 0, r.n_tokens) for r in V.token_counts(df, P.path("piece_bpe_32k.model")).collect())
    assert got == sorted((d is None, d or 0, count(library, t or "")) for d, t, *_ in rows)


def test_scores_and_ties_by_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(300):
        pieces = {"".join(rng.choice(list("ab"), rng.integers(1, 4))) for _ in range(6)}
        vocab = [("<unk>", 0.0)] + [(p, -float(rng.integers(1, 4))) for p in sorted(pieces)]
        counter, own = V.Counter(vocab), Tokenizer(models.Unigram(vocab, unk_id=0))
        text = "".join(rng.choice(list("ab"), rng.integers(1, 12)))
        paths = [(0.0, 0)]  # the best score alone, over all ways
        best = [0.0]
        for e in range(1, len(text) + 1):
            ways = [best[e - len(p)] + s for p, s in vocab[1:] if text[:e].endswith(p)]
            if text[e - 1] not in pieces:
                ways.append(best[e - 1] + counter.unknown)
            best.append(max(ways))
        assert counter.best(text)[0] == best[-1]
        if set(text) <= pieces:
            assert counter.best(text)[1] == len(own.encode(text).ids), (vocab, text)
        del paths


def test_empty_table(spark):
    assert V.token_counts(spark.createDataFrame([], "doc_id long, text string"), P.path("piece_bpe_32k.model")).collect() == []


def test_float_scores_and_inner_spaces_equal_the_library(spark, tmp_path):
    import sentencepiece

    rng = np.random.default_rng(10)
    for _ in range(300):
        pieces = {"".join(rng.choice(list("ab" + V.SPACE), rng.integers(1, 5))) for _ in range(9)} | {"a", "b", V.SPACE}
        vocab = [("<unk>", 0.0)] + [(p, -float(rng.random() * 5)) for p in sorted(pieces)]
        assert not V.segmented(vocab)
        text = "".join(rng.choice(list("ab" + V.SPACE), rng.integers(1, 40)))
        assert V.Counter(vocab).best(text)[1] == len(Tokenizer(models.Unigram(vocab, unk_id=0)).encode(text).ids), (vocab, text)
    words = ["".join(rng.choice(list("etaoinsh"), rng.integers(1, 9))) for _ in range(300)]
    lines = [" ".join(rng.choice(words, 12)) for _ in range(400)]
    prefix = str(tmp_path / "uni")
    sentencepiece.SentencePieceTrainer.train(sentence_iterator=iter(lines), model_prefix=prefix, model_type="unigram", vocab_size=500, byte_fallback=True, hard_vocab_limit=False, minloglevel=2)
    vocab = V.load_vocabulary(prefix + ".model")
    library = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    texts = [*ODD, *lines[:100], None, " ".join(lines)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r.id: r for r in V.token_counts(df, prefix + ".model").collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == [count(library, t or "") for t in texts]
    counter = V.Counter(vocab)
    assert all(got[i].score == (counter.best(V.SPACE + t.replace(" ", V.SPACE))[0] if t else 0.0) for i, t in enumerate(texts))
