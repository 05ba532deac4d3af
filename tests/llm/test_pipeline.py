"""The pipeline on the smallest tables: every stage against a plain version of its rule."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from notchline.llm.bpe_backtrack import load_ranks
from notchline.llm.simhash_anchor import drop_near_duplicates
from tests.conftest import SF_SMALL

from notchline.llm.template_decon import COVER as C_COVER

from .test_fuzzy_lines import slow as slow_lines
from .test_simhash_anchor import slow_groups
from .test_template_decon import slow as slow_decon
from .test_template_decon import tokens


def slow_copies(rows, bench):
    """Rows that hold 13 words in a row of an item, or the whole of a shorter one, in any case. The items of this
    table have no slots that conflict and no names of several words, so nothing else is found."""
    low = lambda t: [w.lower().replace("ß", "ss") for w in tokens(t)]
    grams = set()
    for _, t in bench:
        w = low(t)
        n = min(C_COVER, len(w))
        grams |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n >= 2 else set()
    sizes = {len(g) for g in grams}
    return {d for d, t in rows for w in [low(t)] if any(tuple(w[i : i + n]) in grams for n in sizes for i in range(len(w) - n + 1))}


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = C.table(spark, SF_SMALL, "documents"), []
    columns = docs.columns
    for name, stage in C.STAGES:
        got = C.stored(stage(spark, docs, SF_SMALL), name)
        assert name == "byte_bpe" or got.columns == columns
        out.append((docs.collect(), got.collect()))
        docs = got
    return out


def test_toxicity_rejects_most_toxic_and_few_clean(spark, stages):
    before, after = stages[0]
    kept = {r.doc_id for r in after}
    truth = {r.doc_id: r.toxic for r in C.table(spark, SF_SMALL, "labels").collect()}
    clean = [r.doc_id for r in before if truth.get(r.doc_id) == 0]
    assert sum(d in kept for d in clean) >= 0.95 * len(clean)
    assert {r.doc_id: r.text for r in after}.items() <= {r.doc_id: r.text for r in before}.items()


def test_line_dedup(stages):
    before, after = stages[1]
    want = slow_lines([(r.doc_id, r.text) for r in before], None, 0.8)
    assert sum(r[3] for r in want) > 20
    assert sorted((r.doc_id, r.text) for r in after) == sorted(r[:2] for r in want)
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)


def test_near_dedup(stages):
    before, after = stages[2]
    groups = slow_groups([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == [d for d, _, c in groups if d == c]


def test_decontamination(spark, stages):
    before, after = stages[3]
    bench = [(r.item_id, r.text) for r in C.table(spark, SF_SMALL, "benchmark").collect()]
    bad = {r[0] for r in slow_decon([(r.doc_id, r.text) for r in before], bench) if r[1]}
    bad |= slow_copies([(r.doc_id, r.text) for r in before], bench)
    assert bad
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in bad)


def test_bpe(spark, stages):
    before, after = stages[4]
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in before}
    assert len(after) == len(before)
    for r in after:
        assert r.ids == own.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_near_dedup_of_repeated_and_null_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "A b c"), (None, "x y"), (None, "x y"), (None, "a b c"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(drop_near_duplicates(df).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(1, "a b c"), (None, "x y"), (3, None)], key=lambda r: f"Row(doc_id={r[0]}, text={r[1]!r})")


def test_empty_documents(spark):
    docs = C.table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.collect() == []


def test_columns_that_clash(spark):
    """Other columns, of any name, pass all stages but the last unchanged."""
    docs = C.table(spark, SF_SMALL, "documents").limit(40)
    more = docs.selectExpr("*", "doc_id AS `__key`", "lang AS `__gone`", "source AS `a.b`", "doc_id AS `row`", "lang AS `id`", "lang AS `carried`", "doc_id AS `c0`", "lang AS `score`")
    have = {r.doc_id: r for r in more.collect()}
    for name, stage in C.STAGES[:-1]:
        out = C.stored(stage(spark, more, SF_SMALL), name)
        assert out.columns == more.columns
        got = out.collect()
        assert len(got) > 20
        for r in got:
            assert all(r[c] == have[r.doc_id][c] for c in more.columns if c not in ("text", "n_chars"))
