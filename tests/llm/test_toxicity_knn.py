"""Nearest labelled examples against brute force, and held-out accuracy."""

import math
import tracemalloc
from collections import Counter

import numpy as np

from notchline.llm import toxicity_knn as X

DOCS = "doc_id long, text string, id string, term int"


def corpus(n=600, seed=4):
    rng = np.random.default_rng(seed)
    plain = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st")]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, rng.integers(5, 80)))
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.integers(1, 4)):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(["Vermin", "SCOUNDREL", "rotzig" + str(rng.choice(list("abcdefghij")))])))
        rows.append((i, " ".join(words), "x", 1))
        labels.append((i, toxic))
    return rows, labels


def test_isotonic_is_the_least_squares_fit_on_small_cases():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n = int(rng.integers(1, 7))
        x, y, w = rng.integers(0, 4, n) / 4, rng.integers(0, 2, n).astype(float), rng.integers(1, 4, n).astype(float)
        p, v = X.isotonic(x, y, w)
        assert (np.diff(v) >= -1e-12).all() and abs(sum(w * np.interp(x, p, v)) - sum(w * y)) < 1e-9


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(2)
    n_terms = 60
    vectors = []
    for _ in range(400):
        t = np.sort(rng.choice(n_terms, rng.integers(1, 9), replace=False))
        w = rng.integers(1, 5, len(t)).astype(float)
        vectors.append((t, w / np.sqrt((w * w).sum())))
    index = X.BlockMax(vectors, n_terms, block=16)
    dense = np.zeros((400, n_terms))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(0, 400, 3):
        cosine = (dense @ dense[i]).round(12)
        want = sorted(((c, j) for j, c in enumerate(cosine.tolist()) if c > 0 and j != i), key=lambda x: (-x[0], x[1]))[:10]
        got = index.nearest(*vectors[i], 10, but=i)
        assert [round(c, 9) for c, _ in got] == [round(c, 9) for c, _ in want]
        assert {j for c, j in got if c > got[-1][0] + 1e-9} == {j for c, j in want if c > want[-1][0] + 1e-9}


def test_held_out_accuracy_and_cosines(spark):
    rows, labels = corpus()
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    learn = lab.where(~X.held_out(X.F.col("doc_id")))
    out = {r.id: r for r in X.score_documents(df, learn).collect()}
    truth = dict(labels)
    held = {r.doc_id for r in lab.where(X.held_out(X.F.col("doc_id"))).collect()}
    assert 60 < len(held) < 200 and len(out) == len(rows)
    wrong = [i for i in held if (out[i].score >= 0.5) != truth[i]]
    assert len(wrong) <= 0.05 * len(held)
    assert not held & {e.doc_id for r in out.values() for e in r.evidence}
    # every evidence cosine by brute force over the vocabulary
    model, term_rows = X.train(df, learn)
    vec = {}
    for r in term_rows.collect():
        w = {t: (1 + math.log(f)) * model.idf[t] for t, f in zip(r.term, r.tf, strict=True)}
        norm = math.sqrt(sum(v * v for v in w.values()))
        vec[r.id] = {t: v / norm for t, v in w.items()}
    for i in list(out)[:80]:
        cosine = Counter({j: sum(v * vec[j].get(t, 0) for t, v in vec[i].items()) for j in model.ids})
        want = sorted((c for c in cosine.values() if c > 1e-9), reverse=True)[: X.NEIGHBOURS]
        got = [e.cosine for e in out[i].evidence]
        assert len(got) == len(want) and np.allclose(got, want, rtol=0, atol=1e-9)
        # the score from these neighbours, and the calibration by brute force over the examples
        near = sorted(((-round(c, 12), j) for j, c in cosine.items() if c > 1e-12))[: X.NEIGHBOURS]
        if len(near) < 2 or near[-1][0] != min((-round(c, 12) for j, c in cosine.items() if (-round(c, 12), j) not in near), default=None):
            w = [1 / (max(0, 1 + c) + X.NEAREST) for c, _ in near]
            vote = round(sum(a * truth[j] for a, (_, j) in zip(w, near, strict=True)) / sum(w), 9)
            assert abs(out[i].score - float(np.interp(vote, model.points, model.values))) < 1e-6
    assert model.values.min() >= 0 and model.values.max() <= 1 and len(set(np.round(model.values, 6))) > 1


def test_no_term_is_left_out(spark):
    rows, labels = corpus(120)
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model, found = X.train(df, lab)
    words = {w.lower() for _, t, *_ in rows for w in t.split()}
    assert len(model.idf) == len(words) and (model.idf > 0).all()
    assert all(len(r.term) == len({w.lower() for w in rows[r.id][1].split()}) for r in found.collect())


def test_search_in_batches_equals_one_by_one_and_dense_equals_lists():
    rng = np.random.default_rng(8)
    vectors = []
    for _ in range(500):
        t = np.sort(rng.choice(200, rng.integers(1, 40), replace=False, p=(lambda p: p / p.sum())(1 / np.arange(1, 201))))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum())))
    off = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])])
    term, weight = (np.concatenate([v[k] for v in vectors]) for k in (0, 1))
    got = []
    for dense in (0, 20, 256):
        index = X.BlockMax(vectors, 200, block=16, dense=dense)
        q, c, e = index.search(off, term, weight, 8, np.arange(500))
        got.append([(int(a), round(float(b), 9)) for a, b in zip(q, c, strict=True)])
        assert all([x for x, _ in index.nearest(*vectors[i], 8, but=i)] == c[q == i].tolist() for i in range(0, 500, 50))
    assert got[0] == got[1] == got[2]


def test_nulls_empty_texts_repeats_and_labels_that_cannot_be_used(spark):
    rows, labels = corpus(200)
    long = "ban " * 50000 + "vermin"
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (None, "vermin", "x", 1), (1002, long, "x", 1), (3, rows[3][1], "x", 1)]
    labels += [(None, 1), (1001, None), (5, 7), (6, 1), (6, 1)]
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = X.score_documents(df, lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.id: r for r in got}
    assert by[1000].score == by[1001].score < 0.5 and by[1002].score > 0.5


def test_no_labels_and_empty_tables(spark):
    rows, _ = corpus(20)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in X.score_documents(spark.createDataFrame(rows, DOCS), none).collect()] == [0.0] * 20
    assert X.score_documents(spark.createDataFrame([], DOCS), none).collect() == []


def test_search_reads_postings_of_one_query_at_a_time():
    """Arrays as long as all postings of a batch of queries took most of the search's time and memory."""
    rng = np.random.default_rng(11)

    def vector(n: int) -> tuple[np.ndarray, np.ndarray]:
        w = rng.random(n) + 0.1
        return np.sort(rng.permutation(600)[:n]), w / np.sqrt((w * w).sum())

    index = X.BlockMax([vector(100) for _ in range(1000)], 600)
    queries = [vector(300) for _ in range(64)]
    off = np.arange(65) * 300
    term, weight = (np.concatenate([q[i] for q in queries]) for i in (0, 1))
    tracemalloc.start()
    index.search(off, term, weight, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
