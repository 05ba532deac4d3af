"""Toxicity by the nearest labelled examples.

Exact TF-IDF cosine between every text and labelled examples, over a block-max
inverted index of the examples; the votes of the ``NEIGHBOURS`` nearest, weighted by
distance and calibrated, give the score, and the neighbours are its evidence.

Terms are words (runs of letters, lower case), all that the examples hold. A text's vector is
(1 + ln tf) * idf * (1 + chi2), of length one: chi2 is the chi-square of the term's document counts
among examples of the two labels, so a term that goes with a label weighs more and none is left out.
Document counts for idf are of all documents.

What is bounded: the examples, ``EXAMPLES`` labelled rows at most (half of each
label, those with the smallest hash of their id), and with them the vocabulary, the words of their
texts. Index and vocabulary are model parameters of this size; all else runs over every row.

Index: examples are ordered by their heaviest term and cut into blocks of ``BLOCK``; a posting list is
cut by block, and each part has the highest weight in it. A text's weights times these give an
upper bound of its cosine with any example of the block. The blocks with the highest bounds are
read first; then all whose bound reaches the k-th best cosine found. Terms of many examples are kept as
columns of a matrix instead of lists (the same sums, in one product a block), and texts are scored
``BATCH`` at a time.

Calibration: each example is scored against the others (leave one out, a stage over the
examples), and isotonic regression maps votes to the share of label 1, every label weighted by its true
count. A text without any vocabulary term gets that share among examples without one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline.llm.common import drop_stored, stored, swept, table, text_of, tidy
from notchline.llm.pretokens import STEP

EXAMPLES = 8000
NEIGHBOURS = 16
BLOCK = 64
BATCH = 64  # texts scored at once
FIRST = 2  # blocks read first
DENSE = 256  # most terms kept as columns, those of the most examples
FOLDS = 5
REMEMBERED = 20_000  # texts a worker keeps the neighbours of, for copies
NEAREST = 0.05  # added to a distance before it divides


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _words(text: str = "text") -> Column:
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\p{L}+"), F.lit(0))


def choose_examples(labels: DataFrame, doc_id: str, label: str, bound: int) -> DataFrame:
    """(id, label): at most ``bound`` rows, half of each label, by the hash of their id."""
    one = labels.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    half = [one.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(bound // 2) for k in (0, 1)]
    return half[0].union(half[1])


def choose_terms(examples: DataFrame) -> tuple[list[str], np.ndarray]:
    """All terms of the examples (id, label, text), in order, and the chi-square of each; 0 where
    there is only one label or a term is in every example."""
    sizes = {r.label: r["count"] for r in examples.groupBy("label").count().collect()}
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    words = examples.select("label", F.explode(F.array_distinct(_words())).alias("term"))
    counts = words.groupBy("term").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).toArrow()  # bounded by the examples
    terms = counts.column("term").to_pylist()
    order = sorted(range(len(terms)), key=terms.__getitem__)
    a, b = (counts.column(c).to_numpy().astype(float)[order] for c in ("a", "b"))
    cross, rest = a * (n0 - b) - b * (n1 - a), n1 * n0 * (a + b) * (n1 + n0 - a - b)
    chi2 = np.divide(cross * cross * (n1 + n0), rest, out=np.zeros(len(terms)), where=rest > 0)
    return [terms[i] for i in order], chi2


def term_rows(docs: DataFrame, terms: list[str], doc_id: str, text: str) -> DataFrame:
    """(id, term, tf): for every row the numbers of its vocabulary terms, ascending, and
    how often each occurs. One pass over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # bounded by the examples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shared.value)}
        for b in batches:
            off = b.column(1).offsets.to_numpy().astype(np.int64)
            s = 0
            while s < b.num_rows:  # runs of rows with about STEP words
                e = max(s + 1, int(np.searchsorted(off, off[s] + STEP, side="right")) - 1)
                words = b.column(1).values.slice(int(off[s]), int(off[e] - off[s])).dictionary_encode()
                known = np.fromiter((number.get(w, -1) for w in words.dictionary.to_pylist()), dtype=np.int64, count=len(words.dictionary))
                found = known[words.indices.to_numpy(zero_copy_only=False)]
                owner = np.repeat(np.arange(e - s), np.diff(off[s : e + 1]))
                key, tf = np.unique((owner * max(1, len(number)) + found)[found >= 0], return_counts=True)
                row, term = np.divmod(key, max(1, len(number)))
                upto = pa.array(np.searchsorted(row, np.arange(e - s + 1)), type=pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), *(pa.ListArray.from_arrays(upto, pa.array(x, type=pa.int32())) for x in (term, tf))], names=["id", "term", "tf"])
                s = e

    ints = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("term", ints), T.StructField("tf", ints)])
    return docs.select(F.col(f"`{doc_id}`").alias("id"), text_of(f"`{text}`").alias("text")).select("id", _words().alias("words")).mapInArrow(tidy(run), schema)


def document_counts(rows: DataFrame, n_terms: int) -> np.ndarray:
    """In how many rows each term occurs; a task sums its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms, dtype=np.int64)
        for b in batches:
            counts += np.bincount(b.column(0).flatten().to_numpy(), minlength=n_terms)
        have = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(counts[have])], names=["t", "n"])

    out = np.zeros(n_terms)
    got = rows.select("term").mapInArrow(tidy(run), "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # a row for each vocabulary term
    out[got.column("t").to_numpy()] = got.column("n").to_numpy()
    return out


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], ..., start[i] + size[i] - 1 for all i, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class BlockMax:
    """Block-max inverted index over the examples' unit vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK, dense: int = DENSE):
        lead = [(int(t[np.argmax(w)]), -float(w.max())) for t, w in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (lead[i], i))
        self.block, self.n_blocks = block, -(-len(vectors) // block)
        self.example = np.array(order, dtype=np.int64)  # by place
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[self.example] = np.arange(len(order))
        place = np.repeat(np.arange(len(order), dtype=np.int32), [len(vectors[i][0]) for i in order])
        term = np.concatenate([vectors[i][0].astype(np.int32) for i in order])
        by_term = np.argsort(term, kind="stable")
        term, place = term[by_term], place[by_term]
        weight = np.concatenate([vectors[i][1] for i in order])[by_term]
        del by_term
        often = np.bincount(term, minlength=n_terms)
        top = np.argsort(-often, kind="stable")[:dense]
        self.column = np.full(n_terms, -1, dtype=np.int64)
        top = top[often[top] > len(order) // 16]
        self.column[top] = np.arange(len(top))
        wide = self.column[term] >= 0
        self.matrix = np.zeros((self.n_blocks * block, len(top)))
        self.matrix[place[wide], self.column[term[wide]]] = weight[wide]
        term, self.at, self.weight = term[~wide], place[~wide], weight[~wide]
        first = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(self.at // block, prepend=-1) != 0))  # parts of lists
        self.start, self.size = first, np.diff(np.append(first, len(term)))
        self.start, self.size = self.start.astype(np.int32), self.size.astype(np.int32)
        self.part_block = self.at[first] // block
        self.part_max = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.parts = np.searchsorted(term[first], np.arange(n_terms + 1))
        self.column_max = self.matrix.reshape(self.n_blocks, block, len(top)).max(axis=1).T

    def search(self, off: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, cosine, example) of the k examples with the highest cosine above 0 of every query, best first,
        ties by the smaller number; query i has the terms off[i]:off[i + 1]; example ``but[i]`` is left out."""
        n, nb, width = len(off) - 1, self.n_blocks, self.n_blocks * self.block
        row, column = np.repeat(np.arange(n), np.diff(off)), self.column[term]
        wide = column >= 0
        dense = np.zeros((n, self.matrix.shape[1]))
        dense[row[wide], column[wide]] = weight[wide]
        row, term, weight = row[~wide], term[~wide], weight[~wide]
        size = self.parts[term + 1] - self.parts[term]
        turn = np.repeat(np.arange(len(row)), size)
        part = (self.parts[term] - (np.cumsum(size) - size))[turn] + np.arange(len(turn))
        own, cell = weight[turn], (row * nb)[turn]
        block = self.part_block[part]
        bound = dense @ self.column_max + np.bincount(cell + block, weights=own * self.part_max[part], minlength=n * nb).reshape(n, nb)
        cosine = dense @ self.matrix.T  # a block that is not read stays below its bound
        cuts = np.searchsorted(cell, np.arange(n + 1) * nb).tolist()

        def read(wanted: np.ndarray) -> None:
            """One query after the other: its sums stay in the cache."""
            for q, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                keep = np.flatnonzero(wanted[q][block[s:e]])
                if not len(keep):
                    continue
                chosen = part[s:e][keep]
                size = self.size[chosen]
                turn = np.repeat(np.arange(len(keep)), size)
                at = (self.start[chosen] - (np.cumsum(size) - size))[turn] + np.arange(len(turn))
                cosine[q] += np.bincount(self.at[at], weights=own[s:e][keep][turn] * self.weight[at], minlength=width)
            if but is not None:
                cosine[np.arange(n), self.place[but]] = 0

        best = np.argpartition(-bound, min(FIRST, nb) - 1, axis=1)[:, :FIRST]
        first = np.zeros((n, nb), dtype=bool)
        np.put_along_axis(first, best, True, axis=1)
        first &= bound > 0
        read(first)
        kth = min(k, width)
        seen = np.take_along_axis(cosine.reshape(n, nb, self.block), best[:, :, None], axis=1).reshape(n, -1)
        least = np.partition(seen, seen.shape[1] - kth, axis=1)[:, seen.shape[1] - kth, None] if kth <= seen.shape[1] else 0.0
        read((bound > 0) & ~first & (bound + 1e-9 >= least))
        cosine = cosine.round(12)
        least = np.partition(cosine, width - kth, axis=1)[:, width - kth, None]
        query, place = np.nonzero((cosine >= least) & (cosine > 0))
        value, example = cosine[query, place], self.example[place]
        order = np.lexsort((example, -value, query))
        query, value, example = query[order], value[order], example[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        return query[rank < k], value[rank < k], example[rank < k]

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, but: int = -1) -> list[tuple[float, int]]:
        """``search`` for one query, as (cosine, example)."""
        _, value, example = self.search(np.array([0, len(term)]), np.asarray(term, dtype=np.int64), weight, k, np.array([but]) if but >= 0 else None)
        return list(zip(value.tolist(), example.tolist(), strict=True))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (points, values), values rising with the points."""
    points = np.unique(x)
    groups: list[list[float]] = []
    for p in points.tolist():
        here = x == p
        groups.append([float((w[here] * y[here]).sum()), float(w[here].sum()), 1])
        while len(groups) > 1 and groups[-2][0] * groups[-1][1] >= groups[-1][0] * groups[-2][1]:
            a = groups.pop()
            groups[-1] = [groups[-1][i] + a[i] for i in range(3)]
    values = np.concatenate([np.full(g[2], g[0] / g[1]) for g in groups]) if groups else np.empty(0)
    return points, values


class Model:
    """Examples, term weights and, once ``fit``, calibration; used in tasks."""

    def __init__(self, ids: list, labels: list, vectors: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, weights: tuple[float, float], k: int = NEIGHBOURS):
        self.idf, self.k, self.weights = idf, k, weights
        have = sorted((i for i in range(len(ids)) if len(vectors[i][0])), key=lambda i: ids[i])
        self.ids, self.labels = [ids[i] for i in have], np.array([labels[i] for i in have], dtype=np.float64)
        self.number = {d: i for i, d in enumerate(self.ids)}
        self.index = BlockMax([self.unit(*vectors[i]) for i in have], len(idf)) if have else None
        none = [labels[i] for i in range(len(ids)) if not len(vectors[i][0])]
        ones, zeros = sum(none) * weights[1], (len(none) - sum(none)) * weights[0]
        self.without = ones / (ones + zeros) if none else 0.0
        self.points, self.values = np.empty(0), np.empty(0)

    def unit(self, term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(tf)) * self.idf[term]
        return term, w / np.sqrt((w * w).sum())

    def neighbours(self, off: np.ndarray, term: np.ndarray, tf: np.ndarray, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``BlockMax.search`` for rows of terms, ``BATCH`` at a time."""
        out = []
        if self.index:
            w = (1 + np.log(tf)) * self.idf[term]
            row = np.repeat(np.arange(len(off) - 1), np.diff(off))
            w /= np.sqrt(np.bincount(row, weights=w * w, minlength=len(off) - 1))[row]
            for s in range(0, len(off) - 1, BATCH):
                part = off[s : s + BATCH + 1]
                where = slice(int(part[0]), int(part[-1]))
                query, value, example = self.index.search(part - part[0], term[where], w[where], self.k, None if but is None else but[s : s + BATCH])
                out.append((query + s, value, example))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, dtype=np.int64), np.empty(0), np.empty(0, dtype=np.int64))

    def votes(self, n: int, query: np.ndarray, cosine: np.ndarray, example: np.ndarray) -> np.ndarray:
        """The vote of each of ``n`` queries; -1 without neighbours."""
        w = 1 / (np.maximum(0, 1 - cosine) + NEAREST)
        total = np.bincount(query, weights=w, minlength=n)
        return np.divide(np.bincount(query, weights=w * self.labels[example], minlength=n), total, out=np.full(n, -1.0), where=total > 0).round(9)

    def fit(self, number: np.ndarray, vote: np.ndarray) -> None:
        """Calibrate on the examples' votes."""
        known = vote >= 0
        y = self.labels[number[known]]
        self.points, self.values = isotonic(vote[known], y, np.where(y == 1, self.weights[1], self.weights[0]))

    def scores(self, vote: np.ndarray) -> np.ndarray:
        if not len(self.points):
            return np.full(len(vote), self.without)
        return np.where(vote < 0, self.without, np.interp(vote, self.points, self.values))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES, carry: str | None = None) -> tuple[Model, DataFrame]:
    """(model, term rows (id, carried, term, tf) of every document). ``labels`` are the rows to learn from; of a
    doc_id with several the highest counts; nulls and other values than 0 and 1 are passed over. Of an example with
    several texts the least is taken."""
    few = stored(choose_examples(labels, doc_id, label, examples), "examples")
    # the examples are bounded by ``examples`` rows, hence the broadcast
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), text_of(f"`{text}`").alias("text")).join(F.broadcast(few), "id")
    with_text = stored(texts.groupBy("id", "label").agg(F.min("text").alias("text")), "example-texts")
    terms, chi2 = choose_terms(with_text)
    who = F.struct(F.col(f"`{doc_id}`").alias("id"), (F.col(f"`{carry}`") if carry else F.lit(None)).cast("string").alias("carried"))
    found = term_rows(docs.select(who.alias("who"), F.col(f"`{text}`").alias("text")), terms, "who", "text")
    rows = stored(found.select("id.id", "id.carried", "term", "tf"), "terms")
    n, df = rows.count(), document_counts(rows, len(terms))
    idf = (np.log((1 + n) / (1 + df)) + 1) * (1 + chi2)
    chosen = stored(term_rows(with_text, terms, "id", "text"), "example-terms")
    got = chosen.toArrow().combine_chunks()  # bounded by the examples
    known = {r.id: r.label for r in with_text.select("id", "label").collect()}
    ids = got.column("id").to_pylist()
    vectors = [(t.values.to_numpy().astype(np.int64), f.values.to_numpy()) for t, f in zip(*(got.column(c) for c in ("term", "tf")), strict=True)]
    true = {r.label: r["count"] for r in labels.groupBy(F.col(f"`{label}`").cast("int").alias("label")).count().collect()}
    have = [sum(v == k for v in known.values()) for k in (0, 1)]
    weights = tuple(true.get(k, 0) / have[k] if have[k] else 0.0 for k in (0, 1))
    model = Model(ids, [known[i] for i in ids], vectors, idf, weights)
    del got, vectors
    swept(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for b in batches:
            number = np.array([m.number.get(i, -1) for i in b.column(0).to_pylist()], dtype=np.int64)
            off, term, tf = _flat(b.column(1), b.column(2), number >= 0)
            number = number[number >= 0]
            vote = m.votes(len(number), *m.neighbours(off, term, tf, number))
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(vote)], names=["number", "vote"])

    votes = chosen.select("id", "term", "tf").repartition(docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(tidy(left_out), "number long, vote double").toArrow()
    shared.destroy()
    model.fit(votes.column("number").to_numpy(), votes.column("vote").to_numpy())
    return model, rows


def _flat(term: pa.ListArray, tf: pa.ListArray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, terms, counts) of the chosen rows."""
    off = term.offsets.to_numpy().astype(np.int64)
    size = np.diff(off)[rows]
    at = _ranges(off[:-1][rows], size)
    return np.concatenate([[0], np.cumsum(size)]), term.values.to_numpy()[at].astype(np.int64), tf.values.to_numpy()[at]


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES, carry: str | None = None) -> DataFrame:
    """(id, carried, score, evidence): one row for each row of ``docs``; ``carried`` is the
    value of its column ``carry`` as text, if named; ``evidence`` lists the
    nearest examples (doc_id, label, cosine), the nearest first. Null and empty texts
    get the share of label 1 among examples without vocabulary terms; without any
    labelled row of both labels every score is that share or 0; repeated rows are scored each. Once the result is
    written, its ``release()`` frees the model on the executors and deletes the stored terms."""
    model, rows = train(docs, labels, doc_id, text, label, examples, carry)
    kind = docs.schema[doc_id].dataType
    evidence = T.ArrayType(T.StructType([T.StructField("doc_id", kind), T.StructField("label", T.IntegerType()), T.StructField("cosine", T.DoubleType())]))
    schema = T.StructType([T.StructField("id", kind), T.StructField("carried", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("evidence", evidence)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the examples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        seen: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        names = labels_of = None
        for b in batches:
            if names is None:
                names, labels_of = pa.array(m.ids, type=b.column(0).type), pa.array(m.labels.astype(np.int32))
            off, terms, tfs = _flat(b.column(2), b.column(3), np.ones(b.num_rows, dtype=bool))
            keys = [hashlib.blake2b(terms[s:e].tobytes() + tfs[s:e].tobytes(), digest_size=16).digest() for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            if len(seen) > REMEMBERED:
                seen.clear()
            new = {key: i for i, key in reversed(list(enumerate(keys))) if key not in seen}
            at = np.array(sorted(new.values()), dtype=np.int64)
            size = np.diff(off)[at]
            where = _ranges(off[:-1][at], size)
            query, cosine, example = m.neighbours(np.concatenate([[0], np.cumsum(size)]), terms[where], tfs[where])
            cut = np.searchsorted(query, np.arange(len(at) + 1)).tolist()
            seen |= {keys[i]: (cosine[s:e], example[s:e]) for i, s, e in zip(at.tolist(), cut[:-1], cut[1:], strict=True)}
            found = [seen[key] for key in keys]
            count = np.array([len(c) for c, _ in found], dtype=np.int64)
            cosine, example = np.concatenate([c for c, _ in found]), np.concatenate([e for _, e in found])
            score = m.scores(m.votes(b.num_rows, np.repeat(np.arange(b.num_rows), count), cosine, example))
            picked = pa.array(example, type=pa.int64())
            shown = pa.StructArray.from_arrays([names.take(picked), labels_of.take(picked), pa.array(cosine)], names=["doc_id", "label", "cosine"])
            upto = pa.array(np.concatenate([[0], np.cumsum(count)]), type=pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.ListArray.from_arrays(upto, shown)], names=["id", "carried", "score", "evidence"])

    out = rows.mapInArrow(tidy(run), schema)
    out.release = lambda: (shared.destroy(), drop_stored(rows), swept(docs.sparkSession))
    return out


def op5_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    out = score_documents(table(spark, sf_dir, "documents"), labels.where(~held_out(F.col("doc_id"))))
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


QUERIES = {"op5_toxicity_knn": op5_toxicity_knn}
ORACLE: dict[str, str] = {}
