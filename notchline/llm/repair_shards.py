"""Token ids in binary shards, compressed by a Re-Pair grammar for each shard.

A shard holds the ids of consecutive documents, about ``SHARD`` of them (a document is
never cut). Re-Pair replaces frequent pairs of neighbours by new symbols, again and
again: a round replaces every pair that occurs at least as often as the round's
threshold, then the threshold falls to ``LEAST``, and rounds go on until no pair is left that can be
replaced that often. Rounds find pairs by hash bins, each round by another hash; a round
that finds none is repeated by sorting, which misses none, before the shard is done.
A shard stores its rules (left and right part, by ascending symbol), the first symbol of each
round, the length of every rule's expansion, and the remaining sequence in bit
planes. Lengths make it possible to decode any run of ids alone: running sums of
the lengths tell which symbols of the sequence cover the run.

The file format is Parquet with one row a shard (Spark's commit protocol makes the write
whole when executors are lost). Shards follow in ascending id order: rows are range-partitioned
and sorted by id, ties by text as far as ``TIES`` characters tell; null ids come first. Rows of one id, or without one, are
dealt over as many tasks as they need. ``start`` of a document is the number of ids before it:
the sum of the partitions before (as many rows as there are partitions), of the
shards before it in its partition, and of the documents before it in its shard.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline.llm.common import scratch_path, table, text_of
from notchline.llm.pretokens import BYTE_LEVEL, Store, encoded, gather, pieces_of, split_texts

SHARD = 1 << 18
LEAST = 8
TIES = 16
WORDS = 500
#: Prime multipliers of the pair hash.
MIX = (np.uint32(2654435761), np.uint32(2246822519))


def _by_hash(x: np.ndarray, y: np.ndarray, bins_log2: int, threshold: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in ``x`` and ``y`` whose pair occurs ``threshold`` times or more, bin of each, which places may
    have a pair that occurs ``LEAST`` times: a pair is no more frequent than its bin). Of pairs that
    share a hash bin one is looked at in this round, the others in later ones."""
    bins = (((x ^ np.uint32(turn * 40503)) * MIX[0] ^ y * MIX[1]) >> np.uint32(32 - bins_log2)).astype(np.intp)
    size = np.bincount(bins, minlength=1 << bins_log2)[bins]
    often = np.flatnonzero(size >= threshold)
    bins = bins[often]
    x, y = x[often], y[often]
    holder = np.zeros(1 << bins_log2, dtype=np.intp)
    holder[bins] = np.arange(len(bins))
    first = holder[bins]
    same = np.flatnonzero((x[first] == x) & (y[first] == y))
    kind = bins[same]
    good = np.bincount(kind, minlength=1 << bins_log2)[kind] >= threshold
    return often[same[good]], kind[good], size >= LEAST


def _by_sort(x: np.ndarray, y: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of all pairs, numbered instead of binned."""
    pair = x.astype(np.uint64) << np.uint64(32) | y
    order = np.argsort(pair, kind="stable")
    ranked = pair[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    size = np.diff(np.append(first, len(ranked)))
    number = np.empty(len(pair), dtype=np.int64)
    number[order] = np.repeat(np.where(size >= threshold, np.cumsum(size >= threshold) - 1, -1), size)
    alive = np.empty(len(pair), dtype=bool)
    alive[order] = np.repeat(size >= LEAST, size)
    at = np.flatnonzero(number >= 0)
    return at, number[at], alive


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, left parts, right parts, first symbol of each round) of ``ids`` below ``base``.

    ``act`` are the places whose pair may still occur ``LEAST`` times. A pair never becomes more frequent: its
    symbols were all made in earlier rounds, and what a round makes stands in new pairs. So places of
    rare pairs are looked at again only when a neighbour is replaced."""
    a = ids.astype(np.uint32)
    left, right, rounds, top = [], [], [], base
    act = np.arange(max(0, len(a) - 1))
    threshold, turn, sort = max(LEAST, len(ids) >> 9), 0, False
    while len(a) >= 2 * LEAST and len(act):
        x, y = a[act], a[act + 1]
        bins_log2 = max(8, min(17, len(act).bit_length()))
        at, kind, alive = _by_sort(x, y, threshold) if sort else _by_hash(x, y, bins_log2, threshold, turn)
        at, act = act[at], act[alive]
        turn += 1
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
        free = (np.arange(len(at)) - run) % 2 == 0  # of places that overlap, every second one
        at, kind = at[free], kind[free]
        uses = np.bincount(kind)
        used = uses >= LEAST // 2
        chosen = used[kind]
        at, kind = at[chosen], kind[chosen]
        if not len(at):
            if threshold > LEAST:
                threshold = max(LEAST, threshold >> 2)
            elif sort:
                break
            else:
                sort = True
            continue
        symbol = np.cumsum(used, dtype=np.int64) - 1 + top
        where = np.zeros(len(used), dtype=np.int64)
        where[kind] = at
        left.append(a[where[used]])
        right.append(a[where[used] + 1])
        rounds.append(top)
        top += int(used.sum())
        a[at] = symbol[kind]
        open_, stays = np.zeros(len(a), dtype=bool), np.ones(len(a), dtype=bool)
        open_[act] = True
        open_[at] = True
        open_[at[at > 0] - 1] = True
        stays[at + 1] = False
        a, open_ = a[stays], open_[stays]
        act = np.flatnonzero(open_[:-1])
        threshold, sort = max(LEAST, threshold >> 2), False
    empty = np.empty(0, dtype=np.uint32)
    return a, np.concatenate([empty, *left]), np.concatenate([empty, *right]), np.array(rounds, dtype=np.uint32)


def expand(sequence: np.ndarray, left: np.ndarray, right: np.ndarray, rounds: np.ndarray, base: int) -> np.ndarray:
    """The ids of a sequence: the expansions of all rules, round by round from those before, in one
    pool, and the sequence's symbols out of it."""
    size = np.concatenate([np.ones(base, dtype=np.int64), lengths_of(left, right, rounds, base)])
    pool = np.empty(int(size.sum()), dtype=np.uint32)
    pool[:base] = np.arange(base)
    start = np.cumsum(size) - size
    for s, e in zip(rounds.tolist(), [*rounds[1:].tolist(), base + len(left)], strict=False):
        parts = np.stack([left[s - base : e - base], right[s - base : e - base]], axis=1).ravel()
        whole = gather(pool, start[parts], size[parts])
        pool[start[s] : start[s] + len(whole)] = whole
    return gather(pool, start[sequence], size[sequence])


def lengths_of(left: np.ndarray, right: np.ndarray, rounds: np.ndarray, base: int) -> np.ndarray:
    """The length of every rule's expansion."""
    size = np.ones(base + len(left), dtype=np.uint32)
    ends = [*rounds[1:].tolist(), base + len(left)]
    for s, e in zip(rounds.tolist(), ends, strict=False):
        size[s:e] = size[left[s - base : e - base]] + size[right[s - base : e - base]]
    return size[base:]


def _pack(a: np.ndarray) -> bytes:
    """Symbols as their low 16 bits, then one bit plane for each further bit."""
    high = a >> np.uint32(16)
    planes = [np.packbits((high >> np.uint32(k)).astype(np.uint8) & 1).tobytes() for k in range(int(high.max(initial=0)).bit_length())]
    return a.astype("<u2").tobytes() + b"".join(planes)


def _unpack(data: bytes, n: int) -> np.ndarray:
    a = np.frombuffer(data, dtype="<u2", count=n).astype(np.uint32)
    plane = -(-n // 8)
    for k in range((len(data) - 2 * n) // plane if n else 0):
        bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8, count=plane, offset=2 * n + k * plane), count=n)
        a |= bits.astype(np.uint32) << np.uint32(16 + k)
    return a


class Shard:
    """A stored shard: decodes as a whole or any run of its ids."""

    def __init__(self, n_symbols: int, base: int, sequence: bytes, left: bytes, right: bytes, rounds: bytes, lengths: bytes):
        self.sequence, self.base = _unpack(sequence, n_symbols), base
        self.left, self.right, self.rounds, self.lengths = (np.frombuffer(x, dtype="<u4") for x in (left, right, rounds, lengths))

    def all(self) -> np.ndarray:
        return expand(self.sequence, self.left, self.right, self.rounds, self.base)

    def run(self, start: int, stop: int) -> np.ndarray:
        """ids[start:stop], expanding only the symbols that cover them."""
        size = np.concatenate([np.ones(self.base, dtype=np.int64), self.lengths])[self.sequence]
        ends = np.cumsum(size)
        first, last = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop, side="left"))
        if start >= stop:
            return np.empty(0, dtype=np.uint32)
        got = expand(self.sequence[first : last + 1], self.left, self.right, self.rounds, self.base)
        skip = start - int(ends[first] - size[first])
        return got[skip : skip + stop - start]


_BINARY = ("sequence", "left", "right", "rounds", "lengths")


class _Codec:
    _open: dict[str, _Codec] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.splitting, self.split = self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.store = Store(self.encode)
        self.base = self.tokenizer.get_vocab_size()
        #: bytes of each token: a byte-level vocabulary spells a byte as one character
        self.size = np.zeros(self.base, dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.size[i] = len(token)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and id counts of pre-tokens. They go to the library as the words of
        pre-split texts, which it need not split again; running byte lengths tell where a word's ids end."""
        self.tokenizer.pre_tokenizer = self.split
        texts = [pieces[i : i + WORDS] for i in range(0, len(pieces), WORDS)]
        got = self.tokenizer.encode_batch_fast(texts, is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in got])
        ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(p.encode()) for p in pieces])) + 1
        return ids, np.diff(ends, prepend=0)

    @classmethod
    def of(cls, path: str) -> _Codec:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def whole(self, text: str) -> list[int]:
        self.tokenizer.pre_tokenizer = self.splitting
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def added(path: str) -> list[str]:
        """The tokens that the library takes out of a text before it splits it."""
        from tokenizers import Tokenizer

        return [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]


def write_shards(docs: DataFrame, out: str, tokenizer: str, pattern: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", shard: int = SHARD) -> None:
    """Encode every whole text with the tokenizer file ``tokenizer`` (whose byte-level
    splitting is ``pattern``) as the library does by default (a text that holds one of its added tokens is encoded
    whole by it), append ``end_id`` to each document, and write shards to
    ``out``. A null text counts as empty (its only id is ``end_id``), repeated rows are
    written each, other columns are not read, an empty table gives no shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = _Codec.of(tokenizer), TaskContext.get().partitionId()
        held, rows, n, before, seq = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, rows, n, before, seq
            ids, names = np.concatenate([x for x, _ in held]), pa.concat_arrays(rows)
            sequence, left, right, rounds = compress(ids, codec.base)
            lengths = lengths_of(left, right, rounds, codec.base)
            sizes = np.concatenate([s for _, s in held])
            data = [_pack(sequence), *(x.astype("<u4").tobytes() for x in (left, right, rounds, lengths))]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], type=pa.int32()), x) for x in (names, pa.array(sizes, type=pa.int64()))]
            columns = [pa.array([x], type=t) for x, t in ((part, pa.int32()), (seq, pa.int32()), (before, pa.int64()), (len(ids), pa.int64()), (len(sequence), pa.int64()), (codec.base, pa.int64()))]
            out = pa.RecordBatch.from_arrays([*columns, *lists, *(pa.array([x], type=pa.binary()) for x in data)], names=[f.name for f in schema])
            held, rows, before, seq, n = [], [], before + len(ids), seq + 1, 0
            return out

        split = split_texts(batches) if pattern == BYTE_LEVEL else batches
        for ids_of_rows, tokens, upto in encoded(split, codec.store, codec.whole):
            sizes = np.diff(upto) + 1
            ends = np.cumsum(sizes)
            k = 0
            while k < len(sizes):  # as many documents as fit, one at least
                room = shard - n + (int(ends[k - 1]) if k else 0)
                to = max(k + 1, int(np.searchsorted(ends, room, side="right")))
                ids = np.insert(tokens[upto[k] : upto[to]], upto[k + 1 : to + 1] - upto[k], end_id)
                held.append((ids, sizes[k:to]))
                rows.append(ids_of_rows.slice(k, to - k))
                n += len(ids)
                k = to
                if n >= shard or k < len(sizes):
                    yield close()
        if held:
            yield close()

    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("before", "n_tokens", "n_symbols", "base")), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("doc_tokens", T.ArrayType(T.LongType())), *(T.StructField(c, T.BinaryType()) for c in _BINARY)])
    src = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text"))
    # rows that are alike up to here are dealt by their hash, and equal rows by their number
    spread = [F.substring("text", 1, TIES), F.xxhash64("text"), F.monotonically_increasing_id() % 1024]
    ordered = src.withColumns({f"__{i}": c for i, c in enumerate(spread)}).repartitionByRange("id", "__0", "__1", "__2").sortWithinPartitions("id", "__0", "text")
    added = _Codec.added(tokenizer)
    if pattern == BYTE_LEVEL:
        whole = reduce(or_, [F.col("text").contains(t) for t in added], F.lit(False))
        rows = ordered.select("id", "text", whole.alias("whole"))
    else:
        rows = pieces_of(ordered, pattern, "id", "text", added=added)
    rows.mapInArrow(run, schema).write.parquet(out)


def _shards(b: pa.RecordBatch) -> Iterator[tuple[dict, Shard]]:
    for row in range(b.num_rows):
        at = {name: b.column(i)[row] for i, name in enumerate(b.schema.names)}
        yield at, Shard(at["n_symbols"].as_py(), at["base"].as_py(), *(at[c].as_py() for c in _BINARY))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every stored document, from the shards' data."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, shard in _shards(b):
                ids, size = shard.all().astype("<u4"), at["doc_tokens"].values.to_numpy()
                end = np.cumsum(size)
                crc = [zlib.crc32(ids[s:e]) for s, e in zip((end - size).tolist(), end.tolist(), strict=True)]
                part = np.full(len(size), at["part"].as_py(), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([at["doc_ids"].values, pa.array(part), pa.array(end - size + at["before"].as_py()), pa.array(size), pa.array(crc, type=pa.int64())], names=["id", "part", "inside", "n_tokens", "ids_crc32"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("part", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("inside", "n_tokens", "ids_crc32"))])
    docs = files.mapInArrow(run, schema)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each partition of the write
    base = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return docs.join(base, "part").select("id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_runs(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Random access: (id, ids) of the documents whose id is in ``wanted`` (column ``id``),
    expanding only the symbols that cover them."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType
    at = files.select("part", "seq", F.posexplode("doc_ids").alias("k", "id")).join(wanted.select("id").distinct(), "id")
    asked = at.groupBy("part", "seq").agg(F.collect_list("k").alias("asked"))  # bounded by the documents of a shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, shard in _shards(b):
                end = np.cumsum(row["doc_tokens"].values.to_numpy())
                ks = row["asked"].values.to_numpy()
                got = [shard.run(int(end[k - 1]) if k else 0, int(end[k])).astype(np.int64) for k in ks]
                yield pa.RecordBatch.from_arrays([row["doc_ids"].values.take(pa.array(ks)), pa.array(got, type=pa.list_(pa.int64()))], names=["id", "ids"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.LongType()))])
    return files.join(asked, ["part", "seq"]).mapInArrow(run, schema)


def op2_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    path = scratch_path(spark, "repair-shards")
    write_shards(table(spark, sf_dir, "documents"), path, P.path("byte_bpe_50k.json"), P.PATTERN)
    return read_documents(spark, path).withColumnRenamed("id", "doc_id")


QUERIES = {"op2_repair_shards": op2_repair_shards}
ORACLE: dict[str, str] = {}
