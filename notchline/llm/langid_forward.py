"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a public vocabulary (a sentencepiece model; a leading U+2581 marks the
beginning of a word). Every language has its own piece probabilities. A word's probability in a
language is the sum, over all ways to cut it into pieces, of the product of its pieces'
probabilities, found by the forward algorithm; a text's is the product over its words (runs of
letters, lower case). The language with the highest posterior wins, ties by the smaller name.

A character that is no piece of its own is the product of its UTF-8 bytes' pieces, so every
word has a segmentation.

Training is expectation maximisation: a task adds up the pieces' expected counts
(forward-backward) over its rows, the sums meet in one aggregate, and the driver gets one number
for each (language, piece) that occurs. Probabilities are smoothed by those of all languages
together. What is bounded: ``EXAMPLES`` documents of each language, on average (the fraction
of rows whose hash lies under the share that gives this number), and the model: vocabulary
times number of languages. Priors are counts of all rows to learn from; every row is scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline.llm.common import drop_stored, stored, table, text_of

SPACE = "▁"
END = "\n"  # between words; no letter
EXAMPLES = 1000
ROUNDS = 3
SMOOTH = 1000.0  # pieces' worth of the probabilities of all languages that every language is given
PRIOR = 0.01  # count given to every piece of the vocabulary
FOLDS = 5
REMEMBERED = 250_000  # words a worker keeps the scores of
STEP = 1 << 19
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


class Pieces:
    """A vocabulary: finds every piece in a batch of words at once."""

    _open: dict[str, Pieces] = {}

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.automaton = ahocorasick.Automaton()
        single, byte = [], {}
        for i, p in enumerate(pieces):
            if len(p) == 6 and p.startswith("<0x"):
                byte[int(p[3:5], 16)] = i
            elif p and not p.startswith("<") and END not in p:
                self.automaton.add_word(p, i)
                if len(p) == 1:
                    single.append(ord(p))
        self.automaton.make_automaton()
        self.single = np.array(sorted(single), dtype=np.uint32)
        self.byte = byte

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._open:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            cls._open[path] = cls([model.id_to_piece(i) for i in range(model.get_piece_size())])
        return cls._open[path]

    def lattice(self, words: list[str]) -> Lattice:
        return Lattice(self, words)


class Lattice:
    """All arcs of a batch of words, ordered by the place in the word where they end."""

    def __init__(self, pieces: Pieces, words: list[str]):
        joined = END.join(SPACE + w for w in words) + END
        code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        ends = np.flatnonzero(code == ord(END))
        self.first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.empty(0, dtype=np.int64)
        self.last = ends  # node p stands before character p
        found = np.array(list(pieces.automaton.iter(joined)), dtype=np.int64).reshape(-1, 2)
        start, end, piece = found[:, 0] + 1 - pieces.size[found[:, 1]], found[:, 0] + 1, found[:, 1]
        # arcs by bytes: their pieces are listed apart, one row for each byte
        odd = np.flatnonzero(~np.isin(code, pieces.single) & (code != ord(END)))
        spelt = [[pieces.byte[x] for x in joined[p].encode()] for p in odd.tolist()]
        self.byte_arc = len(start) + np.repeat(np.arange(len(odd)), [len(s) for s in spelt])
        self.byte_piece = np.array([i for s in spelt for i in s], dtype=np.int64)
        start, end = np.concatenate([start, odd]), np.concatenate([end, odd + 1])
        self.piece = np.concatenate([piece, np.full(len(odd), -1)])
        owner = np.searchsorted(self.last, start, side="right")
        level = end - self.first[owner]
        order = np.lexsort((end, level))
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        self.byte_arc = back[self.byte_arc]
        self.start, self.end, self.piece, self.owner = start[order], end[order], self.piece[order], owner[order]
        self.nodes = len(code) + 1
        self.steps = np.flatnonzero(np.diff(level[order], prepend=-1, append=-1))

    def weights(self, logp: np.ndarray) -> np.ndarray:
        """(arcs, columns) of the log probabilities (pieces, columns)."""
        out = logp[np.maximum(self.piece, 0)]
        if len(self.byte_piece):
            out[self.piece < 0] = 0
            np.add.at(out, self.byte_arc, logp[self.byte_piece])
        return out

    def _run(self, weight: np.ndarray, source: np.ndarray, target: np.ndarray, steps: list[tuple[int, int]], begin: np.ndarray) -> np.ndarray:
        total = np.full((self.nodes, weight.shape[1]), -np.inf)
        total[begin] = 0
        for s, e in steps:
            value = total[source[s:e]] + weight[s:e]
            at = target[s:e]
            cut = np.flatnonzero(np.diff(at, prepend=-1))
            top = np.maximum.reduceat(value, cut, axis=0)
            top = np.where(np.isfinite(top), top, 0)
            runs = np.diff(np.append(cut, e - s))
            total[at[cut]] = np.log(np.add.reduceat(np.exp(value - np.repeat(top, runs, axis=0)), cut, axis=0)) + top
        return total

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Log sum over the segmentations of every prefix, by node."""
        with np.errstate(divide="ignore"):
            return self._run(weight, self.start, self.end, list(zip(self.steps[:-1].tolist(), self.steps[1:].tolist(), strict=True)), self.first)

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """The same of every suffix."""
        rest = self.last[self.owner] - self.start
        order = np.lexsort((self.start, rest))
        edge = np.flatnonzero(np.diff(rest[order], prepend=-1, append=-1))
        with np.errstate(divide="ignore"):
            return self._run(weight[order], self.end[order], self.start[order], list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)), self.last)

    def expected(self, logp: np.ndarray, column: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(column, piece, expected count): word i is of the language ``column[i]`` and occurs ``times[i]`` times."""
        lang = column[self.owner]
        weight = logp[np.maximum(self.piece, 0), lang]
        if len(self.byte_piece):
            weight[self.piece < 0] = 0
            np.add.at(weight, self.byte_arc, logp[self.byte_piece, lang[self.byte_arc]])
        weight = weight[:, None]
        ahead, after = self.forward(weight)[:, 0], self.backward(weight)[:, 0]
        share = np.exp(ahead[self.start] + weight[:, 0] + after[self.end] - ahead[self.last][self.owner]) * times[self.owner]
        plain = self.piece >= 0
        piece = np.concatenate([self.piece[plain], self.byte_piece])
        return np.concatenate([lang[plain], lang[self.byte_arc]]), piece, np.concatenate([share[plain], share[self.byte_arc]])


class Model:
    """Languages, priors and log probabilities (pieces, languages)."""

    def __init__(self, langs: list[str], prior: np.ndarray, logp: np.ndarray):
        self.langs, self.prior, self.logp = langs, prior, logp


class Scores:
    """Log probabilities of the words seen so far; bounded by ``REMEMBERED`` words."""

    def __init__(self, pieces: Pieces, model: Model):
        self.pieces, self.logp = pieces, model.logp
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.pool = np.empty((1 << 14, self.logp.shape[1]))

    def rows(self, words: list[str]) -> np.ndarray:
        """(words, languages)"""
        if len(self.at) + len(words) > REMEMBERED:
            self.clear()
        new = [w for w in words if w not in self.at]
        for i in range(0, len(new), 1 << 14):
            part = new[i : i + (1 << 14)]
            lattice = self.pieces.lattice(part)
            n = len(self.at)
            while n + len(part) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
            self.pool[n : n + len(part)] = lattice.forward(lattice.weights(self.logp))[lattice.last]
            self.at.update(zip(part, range(n, n + len(part)), strict=True))
        return self.pool[np.fromiter((self.at[w] for w in words), dtype=np.int64, count=len(words))]


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of expected counts (pieces, languages)."""
    common = counts.sum(axis=1) + PRIOR
    common /= common.sum()
    return np.log((counts + SMOOTH * common[:, None]) / (counts.sum(axis=0) + SMOOTH))


def _gathered(rows: DataFrame, n_pieces: int, n_langs: int) -> np.ndarray:
    """Sums of (lang, piece, n) rows; at most one a piece and language reaches the driver."""
    out = np.zeros((n_pieces, n_langs))
    got = rows.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    out[got["piece"].to_numpy(dtype=np.int64), got["lang"].to_numpy(dtype=np.int64)] = got["n"]
    return out


def expected_counts(words: DataFrame, vocabulary: str, logp: np.ndarray | None, n_langs: int) -> np.ndarray:
    """Expected piece counts of the table (lang number, word, n) under ``logp``; without
    it every piece that stands anywhere in a word counts, shorter ones less."""
    shared = words.sparkSession.sparkContext.broadcast(logp)  # vocabulary x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = Pieces.of(vocabulary), shared.value
        counts = np.zeros(pieces.n * n_langs)
        for b in batches:
            lang, texts, times = b.column(0).to_numpy(), b.column(1).to_pylist(), b.column(2).to_numpy().astype(float)
            for i in range(0, len(texts), 1 << 14):
                part = slice(i, i + (1 << 14))
                lattice = pieces.lattice(texts[part])
                if known is None:
                    plain = lattice.piece >= 0
                    piece = np.concatenate([lattice.piece[plain], lattice.byte_piece])
                    owner = np.concatenate([lattice.owner[plain], lattice.owner[lattice.byte_arc]])
                    c, share = lang[part][owner], times[part][owner] * pieces.size[piece]
                else:
                    c, piece, share = lattice.expected(known, lang[part], times[part])
                counts += np.bincount(c.astype(np.int64) * pieces.n + piece, weights=share, minlength=len(counts))
        have = np.flatnonzero(counts)
        columns = [pa.array((have // pieces.n).astype(np.int32)), pa.array((have % pieces.n).astype(np.int32)), pa.array(counts[have])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "piece", "n"])

    out = _gathered(words.mapInArrow(run, "lang int, piece int, n double"), Pieces.of(vocabulary).n, n_langs)
    shared.destroy()
    return out


def train(rows: DataFrame, vocabulary: str, doc_id: str = "doc_id", lang: str = "lang", text: str = "text", examples: int = EXAMPLES, rounds: int = ROUNDS) -> Model:
    """Learn from ``rows`` with a language. Without any the model has no language."""
    src = rows.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), text_of(f"`{text}`").alias("text")).where("lang is not null")
    count = {r.lang: r["count"] for r in src.groupBy("lang").count().collect()}  # a row for each language
    langs = sorted(count)
    if not langs:
        return Model([], np.empty(0), np.empty((0, 0)))
    names = F.create_map(*(x for i, k in enumerate(langs) for x in (F.lit(k), F.struct(F.lit(i).alias("number"), F.lit(min(1.0, examples / count[k])).alias("share")))))
    drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < F.col("of.share") * (1 << 30)
    few = src.withColumn("of", names[F.col("lang")]).where(drawn)
    words = few.select(F.col("of.number").alias("lang"), F.explode(words_of(F.col("text"))).alias("word"))
    counted = stored(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "langid-words")
    logp = None
    for _ in range(rounds + 1):
        logp = smoothed(expected_counts(counted, vocabulary, logp, len(langs)))
    drop_stored(counted)
    total = np.array([count[k] for k in langs], dtype=float)
    return Model(langs, np.log(total / total.sum()), logp)


def predict_languages(docs: DataFrame, model: Model, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score, n_words) for every row: the language with the highest posterior and that
    posterior. Null and empty texts, texts without a letter, and all texts under a model without
    languages give 'und' and 0; repeated rows are scored each, other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary x languages
    held: list[Scores] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        held[:] = [Scores(Pieces.of(vocabulary), m)] if m.langs else []
        for b in batches:
            off = b.column(1).offsets.to_numpy().astype(np.int64)
            words = b.column(1).values
            total = np.tile(m.prior, (b.num_rows, 1)) if m.langs else np.zeros((b.num_rows, 0))
            for s in range(int(off[0]) if held else int(off[-1]), int(off[-1]), STEP):
                e = min(s + STEP, int(off[-1]))
                part = words.slice(s, e - s).dictionary_encode()
                score = held[0].rows(part.dictionary.to_pylist())[part.indices.to_numpy(zero_copy_only=False)]
                row = np.searchsorted(off, np.arange(s, e), side="right") - 1
                cut = np.flatnonzero(np.diff(row, prepend=-1))
                total[row[cut]] += np.add.reduceat(score, cut, axis=0)
            size = np.diff(off)
            none = (size == 0) | (not m.langs)
            if m.langs:
                best = total.argmax(axis=1)
                sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, sure = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows)
            names = [UNKNOWN if n else m.langs[i] for i, n in zip(best.tolist(), none.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, type=pa.string()), pa.array(np.where(none, 0.0, sure)), pa.array(size)], names=["id", "lang_pred", "score", "n_words"])
        held.clear()

    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType())])
    src = docs.select(F.col(f"`{doc_id}`").alias("id"), words_of(text_of(f"`{text}`")).alias("words"))
    return src.mapInArrow(run, schema)


def op11_langid_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    vocabulary = P.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), vocabulary)
    out = predict_languages(docs, model, vocabulary)
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "n_words")


QUERIES = {"op11_langid_forward": op11_langid_forward}
ORACLE: dict[str, str] = {}
