"""Count-only Viterbi over a unigram vocabulary.

pyahocorasick enumerates, for every end in a segment, the vocabulary pieces that end
there; dynamic programming keeps the best score and its piece count for each
place, and no back pointers, so memory is two numbers a character.

Tie rules are those of the Unigram model of the ``tokenizers`` library: scores are
added in 64-bit floats; at each end, of equal scores the longest last piece wins; a
character that is no piece of its own costs the lowest score less 10 and comes last;
it counts as its UTF-8 bytes (byte fallback).

Spaces become U+2581 (one that stands in the text is the same) and one is put in front of a text that is not empty. If no
vocabulary piece has another character before a U+2581, the best path of a text
is that of its segments (spaces, then other characters) one after the other; if the scores
are whole numbers too, whose sums are exact, ties fall alike. Each distinct segment of a batch
is scored once then. For all other vocabularies the same programming runs over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline.llm.common import table
from notchline.llm.pretokens import STEP, pieces_of

SPACE = "▁"
SEGMENTS = " *[^ ]+| +"
KEPT = 1_000_000  # segments a worker remembers


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def segmented(vocabulary: list[tuple[str, float]]) -> bool:
    """Whether a text may be scored segment by segment."""
    return all(s == int(s) and SPACE not in p.lstrip(SPACE) for p, s in vocabulary)


class Counter:
    """Scores and counts segments; one for each vocabulary in a Python worker."""

    _open: dict[str, Counter] = {}

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.pieces.add_word(piece, (len(piece), float(score)))
        self.pieces.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - 10.0
        self.seen: dict[str, tuple[float, int]] = {}

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in cls._open:
            cls._open[path] = cls(load_vocabulary(path))
        return cls._open[path]

    def best(self, segment: str) -> tuple[float, int]:
        """(score, pieces) of the best path through a segment (spaces already U+2581)."""
        ends: list[list[tuple[int, float]]] = [[] for _ in segment]
        for last, match in self.pieces.iter(segment):
            ends[last].append(match)
        score, count = [0.0], [0]
        for last, matches in enumerate(ends):
            top = pieces = None
            for n, own in sorted(matches, reverse=True):  # the longest first: a tie stays with it
                new = score[last + 1 - n] + own
                if top is None or new > top:
                    top, pieces = new, count[last + 1 - n] + 1
            if not matches or min(matches)[0] > 1:
                new = score[last] + self.unknown
                if top is None or new > top:
                    top, pieces = new, count[last] + len(segment[last].encode())
            score.append(top)
            count.append(pieces)
        return score[-1], count[-1]

    def of_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        seen = self.seen
        if len(seen) + len(segments) > KEPT:
            seen.clear()
        for s in segments:
            if s not in seen:
                seen[s] = self.best(s.replace(" ", SPACE))
        return tuple(np.array([seen[s][k] for s in segments], dtype=(np.float64, np.int64)[k]) for k in (0, 1))


    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``of_segments``, for whole texts: none is remembered."""
        got = [self.best(t.replace(" ", SPACE)) for t in texts]
        return tuple(np.array([x[k] for x in got], dtype=(np.float64, np.int64)[k]) for k in (0, 1))


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, score) of every row's whole text. Null and empty texts have 0
    tokens and score 0; repeated rows are counted each; other columns are not read."""

    cut_up = segmented(load_vocabulary(path))

    def run(batches: Iterable[pa.RecordBatch]):
        counter = Counter.of(path)
        for b in batches:
            off = b.column(1).offsets.to_numpy().astype(np.int64)
            row = 0
            while row < b.num_rows:
                end = max(row + 1, int(np.searchsorted(off, off[row] + STEP, side="right")) - 1)
                found = b.column(1).values.slice(int(off[row]), int(off[end] - off[row])).dictionary_encode()
                score, count = (counter.of_segments if cut_up else counter.of_texts)(found.dictionary.to_pylist())
                at = found.indices.to_numpy(zero_copy_only=False)
                cut = off[row : end + 1] - off[row]
                n, s = (np.diff(np.concatenate([[0], np.cumsum(x[at])])[cut]) for x in (count, score))
                if not cut_up:  # one piece a text or none: its score as it is, without sums of floats
                    s = np.zeros(end - row)
                    s[np.diff(cut) > 0] = score[at]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, end - row), pa.array(n), pa.array(s)], names=["id", "n_tokens", "score"])
                row = end

    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])
    spaced = F.concat(F.lit(" "), F.translate("text", SPACE, " "))
    segments = F.regexp_extract_all(spaced, F.lit(SEGMENTS), F.lit(0)) if cut_up else F.array(spaced)
    split = F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(segments)
    return pieces_of(docs, None, doc_id, text, split).select("id", "pieces").mapInArrow(run, schema)


def op3_viterbi_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return token_counts(table(spark, sf_dir, "documents"), P.path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


QUERIES = {"op3_viterbi_count": op3_viterbi_count}
ORACLE: dict[str, str] = {}
