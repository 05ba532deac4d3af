"""Alignment of two tokenizers' tokens over the bytes of the same text.

Tokenizer A is byte-level BPE (a ``tokenizers`` file), B a sentencepiece model. Both
encode a text with one space before it. Byte offsets where tokens of both end cut
the tokens into groups; an A and a B token whose byte ranges overlap are linked. The count of a pair of
ids is the number of documents that hold it linked.

No token of either reaches over a space that follows a visible character, so texts are split there by
Spark, and each distinct stretch is encoded and aligned once (bounded memory, ``REMEMBERED``
bytes); the groups and links of a text are those of its stretches one after the other.

Counting: ``same[a]`` is the B id with the bytes of A id a, if there is one. Pairs (a, same[a]) -- all exact one-to-one
groups, most of the links -- are counted in one vector of the length of A's vocabulary in each task; only the other pairs,
distinct within a text and summed within a batch, enter the pair shuffle. Scores go back the same way:
the vector is broadcast (its length is the vocabulary's), the other pairs' counts are broadcast
up to ``BROADCAST`` pairs (counted), else the join shuffles.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline.llm.common import stored, table, text_of
from notchline.llm.pretokens import gather

SPACE = "▁"
#: Where a text may be cut: before a space, after a character that no tokenizer takes for white space.
CUT = r"(?<=[!-~\p{L}\p{N}])(?= )"
STEP = 1 << 18
WORDS = 1 << 12
REMEMBERED = 96 << 20  # bytes of distinct stretches that a worker keeps, about
BROADCAST = 1_000_000
WIDTH = 1 << 32  # a pair is a * WIDTH + b


class Tokenizers:
    """Both vocabularies and the stretches seen so far; one in a Python worker."""

    _open: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # in a text they are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        bytes_b = [self._bytes_b(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.space = self.b.piece_to_id(SPACE)
        self.size_a, self.start_a, self.pool_a = _table(bytes_a)
        self.size_b, self.start_b, self.pool_b = _table(bytes_b)
        #: of several B ids with the same bytes the highest: the piece, not its byte form
        id_of = {x: i for i, x in enumerate(bytes_b) if x}
        self.same = np.array([id_of.get(x, -1) for x in bytes_a], dtype=np.int64)
        self.clear()

    @staticmethod
    def _bytes_b(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Tokenizers:
        key = (path_a, path_b)
        if key not in cls._open:
            cls._open[key] = cls(*key)
        return cls._open[key]

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.groups: list[str] = []
        self.held = 0
        self.counts = np.empty((1 << 12, 4), dtype=np.int64)  # a, b, groups, links; -1 in the first if bytes differ
        self.start = np.empty(1 << 12, dtype=np.int64)
        self.pool, self.used = np.empty(1 << 14, dtype=np.int64), 0

    def encode_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids one after the other, and how many each text has. Texts go to the library as words
        of a pre-split text; byte lengths tell where a text's ids end."""
        lists = [texts[i : i + WORDS] for i in range(0, len(texts), WORDS)]
        ids = np.concatenate([np.array(e.ids, dtype=np.int64) for e in self.a.encode_batch_fast(lists, is_pretokenized=True, add_special_tokens=False)])
        ends = np.searchsorted(np.cumsum(self.size_a[ids]), np.cumsum([len(t.encode()) for t in texts])) + 1
        return ids, np.diff(ends, prepend=0)

    def encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [x if t != " " else [self.space] for x, t in zip(self.b.encode([t[1:] for t in texts], num_threads=1), texts, strict=True)]
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        return np.fromiter((i for x in got for i in x), dtype=np.int64, count=int(sizes.sum())), sizes

    def numbers(self, texts: list[str]) -> np.ndarray:
        """The number of each stretch; new ones are encoded and aligned first. A stretch begins with a space."""
        new = [t for t in texts if t not in self.at]
        if new and self.held > REMEMBERED:
            self.clear()
            new = texts
        for i in range(0, len(new), 1 << 14):
            self._add(new[i : i + (1 << 14)])
        return np.fromiter((self.at[t] for t in texts), dtype=np.int64, count=len(texts))

    def _add(self, texts: list[str]) -> None:
        (a, n_a), (b, n_b) = self.encode_a(texts), self.encode_b(texts)
        raw = [t.encode() for t in texts]
        size = np.array([len(x) for x in raw])
        whole = np.frombuffer(b"".join(raw), dtype=np.uint8)
        good = np.ones(len(texts), dtype=bool)
        for ids, n, sizes, starts, pool in ((a, n_a, self.size_a, self.start_a, self.pool_a), (b, n_b, self.size_b, self.start_b, self.pool_b)):
            row = np.repeat(np.arange(len(texts)), n)
            equal = np.bincount(row, weights=sizes[ids], minlength=len(texts)) == size
            part = gather(pool, starts[ids], sizes[ids])
            wide = np.repeat(equal[row], sizes[ids])
            differ = part[wide] != whole[np.repeat(equal, size)]
            equal[np.repeat(np.flatnonzero(equal), size[equal])[differ]] = False
            good &= equal
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = np.where(good, n_a, -1), np.where(good, n_b, 0)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.union1d(end_a, end_b)  # between two of them lies one overlap
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        pairs = a[at_a] * WIDTH + b[at_b]
        shared = (end_a[at_a] == ends) & (end_b[at_b] == ends)
        limits = np.cumsum(np.where(good, size, 0))
        row = np.searchsorted(limits, ends)
        n_links, n_groups = np.bincount(row, minlength=len(texts)), np.bincount(row[shared], minlength=len(texts))
        a_words, b_words = a.astype(str).tolist(), b.astype(str).tolist()
        text, i, j = [], 0, 0
        for x, y in zip((at_a[shared] + 1).tolist(), (at_b[shared] + 1).tolist(), strict=True):
            text.append(f"{a_words[i]}|{b_words[j]}" if x - i == 1 == y - j else f"{','.join(a_words[i:x])}|{','.join(b_words[j:y])}")
            i, j = x, y
        n, m = len(self.groups), len(self.groups) + len(texts)
        while m > len(self.counts):
            self.counts, self.start = np.concatenate([self.counts, np.empty_like(self.counts)]), np.concatenate([self.start, np.empty_like(self.start)])
        while self.used + len(pairs) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.counts[n:m] = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        self.start[n:m] = self.used + np.cumsum(n_links) - n_links
        self.pool[self.used : self.used + len(pairs)] = pairs
        self.used += len(pairs)
        upto = np.cumsum(n_groups).tolist()
        self.groups += [";".join(text[s:e]) for s, e in zip([0, *upto[:-1]], upto, strict=True)]
        self.at.update(zip(texts, range(n, m), strict=True))
        self.held += 250 * len(texts) + 2 * len(whole) + 8 * len(pairs) + 12 * len(text)


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(t) for t in tokens], dtype=np.int64)
    return size, np.cumsum(size) - size, np.frombuffer(b"".join(tokens), dtype=np.uint8)


def byte_alphabet() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte: printable Latin-1 is
    itself, the other bytes take the characters from U+0100 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, groups_sha256, ids, id_times, pairs, pair_times) for every row: ``ids``
    are the distinct A ids linked to the B id of the same bytes and how often, ``pairs`` the other
    distinct linked pairs (a * 2^32 + b). ``row`` tells rows apart, ids may repeat or be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers.of(path_a, path_b)
        for b in batches:
            off = b.column(2).offsets.to_numpy().astype(np.int64)
            at = 0
            while at < b.num_rows:
                end = max(at + 1, int(np.searchsorted(off, off[at] + STEP, side="right")) - 1)
                part = b.column(2).values.slice(int(off[at]), int(off[end] - off[at])).dictionary_encode()
                number = both.numbers(part.dictionary.to_pylist())[part.indices.to_numpy(zero_copy_only=False)]
                upto = off[at : end + 1] - off[at]
                yield _aligned(both, b.column(0).slice(at, end - at), b.column(1).slice(at, end - at), number, upto)
                at = end

    ints, longs = T.ArrayType(T.IntegerType(), False), T.ArrayType(T.LongType(), False)
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("id", docs.schema[doc_id].dataType)]
        + [T.StructField(c, T.LongType()) for c in _COUNTS]
        + [T.StructField("groups_sha256", T.StringType()), T.StructField("ids", ints), T.StructField("id_times", ints), T.StructField("pairs", longs), T.StructField("pair_times", ints)]
    )
    source = text_of(f"`{text}`")
    stretches = F.when(source == "", F.array().cast("array<string>")).otherwise(F.split(F.concat(F.lit(" "), source), CUT, -1))
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("id"), stretches.alias("stretches"))
    return src.mapInArrow(run, schema)


def _aligned(both: Tokenizers, row: pa.Array, ids: pa.Array, number: np.ndarray, upto: np.ndarray) -> pa.RecordBatch:
    n = len(row)
    owner = np.repeat(np.arange(n), np.diff(upto))
    counts = both.counts[number]
    bad = np.bincount(owner[counts[:, 0] < 0], minlength=n) > 0
    some = ~bad[owner]
    owner, number, counts = owner[some], number[some], counts[some]
    totals = [np.bincount(owner, weights=counts[:, k], minlength=n).astype(np.int64) for k in range(4)]
    ends = np.cumsum(np.bincount(owner, minlength=n)).tolist()
    shas, known, numbers, s = [], both.groups, number.tolist(), 0
    for e in ends:
        shas.append(hashlib.sha256(";".join([known[i] for i in numbers[s:e]]).encode()).hexdigest() if e > s else "")
        s = e
    pair = gather(both.pool, both.start[number], counts[:, 3])
    holder = np.repeat(owner, counts[:, 3])
    a, b = np.divmod(pair, WIDTH)
    regular = both.same[a] == b

    def lists(value: np.ndarray, of: np.ndarray, kind: pa.DataType) -> list[pa.Array]:
        order = np.lexsort((value, of))
        value, of = value[order], of[order]
        first = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(value, prepend=-1) != 0))
        off = pa.array(np.searchsorted(of[first], np.arange(n + 1)), type=pa.int32())
        times = np.diff(np.append(first, len(of))).astype(np.int32)
        return [pa.ListArray.from_arrays(off, pa.array(value[first], type=kind)), pa.ListArray.from_arrays(off, pa.array(times, type=pa.int32()))]

    columns = [row, ids, *map(pa.array, totals), pa.array(shas, type=pa.string()), *lists(a[regular], holder[regular], pa.int32()), *lists(pair[~regular], holder[~regular], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["row", "id", *_COUNTS, "groups_sha256", "ids", "id_times", "pairs", "pair_times"])


def same_byte_counts(aligned: DataFrame, n_ids: int) -> np.ndarray:
    """In how many rows each A id is linked to the B id of the same bytes: one vector a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_ids, dtype=np.int64)
        for b in batches:
            counts += np.bincount(b.column(0).flatten().to_numpy(), minlength=n_ids)
        have = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(counts[have])], names=["a", "n"])

    out = np.zeros(n_ids, dtype=np.int64)
    got = aligned.select("ids").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n")).toPandas()  # a row for each id
    out[got["a"].to_numpy(dtype=np.int64)] = got["n"]
    return out


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): in how many rows each other pair is linked; summed within a batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pair, n = np.unique(b.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, type=pa.int64()), pa.array(n.astype(np.int64))], names=["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def score_links(aligned: DataFrame, n_ids: int) -> DataFrame:
    """(id, counts, n_best, count_sum, groups_sha256): every row of the table ``aligned`` (stored, so that
    its row numbers stay) with the sum of its links' counts and how many links have their A id's highest count."""
    spark = aligned.sparkSession
    vector = same_byte_counts(aligned, n_ids)
    others = stored(pair_counts(aligned), "link-counts")
    highest = vector.copy()
    top = others.groupBy(F.expr(f"pair div {WIDTH}").alias("a")).agg(F.max("n").alias("n")).toPandas()  # a row for each id
    at = top["a"].to_numpy(dtype=np.int64)
    highest[at] = np.maximum(highest[at], top["n"].to_numpy(dtype=np.int64))
    best = spark.createDataFrame(pa.table({"a": pa.array(at), "highest": pa.array(highest[at])}))  # as many rows
    known = others.join(F.broadcast(best), F.expr(f"pair div {WIDTH}") == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).cast("long").alias("best"))
    known = F.broadcast(known) if others.count() <= BROADCAST else known
    apart = aligned.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "pair_times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.pair_times").alias("times"))
    sums = apart.join(known, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("best_apart"), F.sum(F.col("times") * F.col("n")).alias("sum_apart"))
    shared = spark.sparkContext.broadcast((vector, vector == highest))  # of the length of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, is_best = shared.value
        for b in batches:
            off = b.column(7).offsets.to_numpy()
            ids, times = b.column(7).flatten().to_numpy(), b.column(8).flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), np.diff(off))
            sums = np.zeros((2, b.num_rows), dtype=np.int64)
            np.add.at(sums[0], row, times * is_best[ids])
            np.add.at(sums[1], row, times * count[ids])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(7)), pa.array(sums[0]), pa.array(sums[1])], names=names)

    kept = ["row", "id", *_COUNTS, "groups_sha256"]
    names = [*kept, "best_same", "sum_same"]
    schema = T.StructType([*(aligned.schema[c] for c in kept), T.StructField("best_same", T.LongType()), T.StructField("sum_same", T.LongType())])
    rows = aligned.select(*kept, "ids", "id_times").mapInArrow(run, schema).join(sums, "row", "left")
    n_best, count_sum = (F.col(f"{x}_same") + F.coalesce(F.col(f"{x}_apart"), F.lit(0)) for x in ("best", "sum"))
    return rows.select("id", *_COUNTS, n_best.alias("n_best"), count_sum.alias("count_sum"), "groups_sha256")


def tokenizer_links(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``. Null and empty texts, and texts whose joined token bytes
    differ from the text with a space before it (such as those with U+2581), have no tokens: zeros and ''.
    Repeated rows count as documents each; other columns are not read; an empty table gives an empty result."""
    aligned = stored(align(docs, path_a, path_b, doc_id, text), "aligned")
    return score_links(aligned, len(Tokenizers.of(path_a, path_b).same))


def op13_tokenizer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    out = tokenizer_links(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    return out.withColumnRenamed("id", "doc_id")


QUERIES = {"op13_tokenizer_links": op13_tokenizer_links}
ORACLE: dict[str, str] = {}
