"""Split texts in the JVM, encode each distinct piece once, put the ids together.

A tokenizer that works on pre-tokens gives every occurrence of a piece the same
ids, so a text's ids are its pieces' ids in order. Spark's regular expressions
split the text; a task looks up the distinct pieces of each batch (Arrow's
dictionary encoding) and gathers the ids with numpy, so Python code runs for
distinct pieces only. What a worker remembers is bounded by ``STORE`` bytes.

Splitting patterns use character classes whose members differ between Unicode
versions. Texts with a character outside ``KNOWN`` (where the versions agree) go
through the tokenizer's own splitter whole; the result is the same, only slower.

Texts to be split by ``BYTE_LEVEL`` need not be split in the JVM: ``split_texts`` finds the places of a batch's
pieces side by side and leaves the bytes where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notchline.llm.common import text_of

#: Characters whose classes are the same in every Unicode version in use.
KNOWN = r"\x{0}-\x{24F}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FA5}"
STORE = 48 << 20  # bytes, about
PIECE = 150  # bytes that a remembered piece takes besides its characters and ids
STEP = 1 << 19
SPAN = 1 << 21  # bytes of texts split side by side

#: The pattern that ``split_texts`` splits by.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_classes: list[np.ndarray] = []


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers one after the other, length of each list)."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(sizes.sum())), sizes


class Store:
    """Ids of the pieces seen so far, as one pool. ``encode`` gives the ids of new
    pieces one after the other, and how many each has."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode, self.limit = encode, STORE
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.held = 0
        self.pool = np.empty(1 << 16, dtype=np.uint32)
        self.start, self.size, self.met = (np.empty(1 << 14, dtype=np.int64) for _ in range(3))
        self.used = 0

    def keep_often(self) -> None:
        """Forget the pieces that were asked for least often, about half of the store."""
        names, met = list(self.at), self.met[: len(self.at)]
        few = np.sort(met)[len(met) // 2] if len(met) else 0
        stays = np.flatnonzero(met > few)
        kept = [names[i] for i in stays.tolist()]
        size = self.size[stays]
        ids = gather(self.pool, self.start[stays], size)
        self.clear()
        self.add(kept, ids, size)

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, total = len(self.at), len(ids)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while n + len(pieces) > len(self.start):
            self.start, self.size, self.met = (np.concatenate([x, np.empty_like(x)]) for x in (self.start, self.size, self.met))
        self.start[n : n + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + len(pieces)] = sizes
        self.met[n : n + len(pieces)] = 0
        self.pool[self.used : self.used + total] = ids
        self.used += total
        self.held += PIECE * len(pieces) + sum(map(len, pieces)) + 4 * total
        self.at.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece (no piece twice); new ones are encoded first."""
        if self.held > self.limit:
            self.keep_often()
        number = np.fromiter(map(self.at.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            number[missing] = len(self.at) + np.arange(len(missing))
            new = [pieces[i] for i in missing.tolist()]
            self.add(new, *self.encode(new))
        self.met[number] += 1
        return number


def gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """pool[start[i] : start[i] + size[i]] for all i, one after the other."""
    before = np.cumsum(size) - size
    return pool[np.repeat(start - before, size) + np.arange(int(size.sum()))]


def classes() -> np.ndarray:
    """The class of each character below U+10000; ``_ODD`` outside ``KNOWN``."""
    if not _classes:
        out = np.full(1 << 16, _ODD, dtype=np.uint8)
        ends = [int(x, 16) for x in regex.findall(r"\{(\w+)\}", KNOWN)]
        every = "".join(chr(c) for a, z in zip(ends[::2], ends[1::2], strict=True) for c in range(a, z + 1))
        for number, which in enumerate((r"\s", r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")):
            out[[ord(c) for c in regex.findall(which, every)]] = number
        _classes.append(out)
    return _classes[0]


def piece_starts(raw: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the places in the bytes ``raw`` where a piece begins, places of bytes of characters outside ``KNOWN``);
    ``docs``: the places where texts that are not empty begin. Every byte of a character has the character's class."""
    table, n = classes(), len(raw)
    kind = np.where(raw < 128, table[raw], np.uint8(_ODD))
    lead = np.flatnonzero(raw >= 0xC2)
    if len(lead):
        padded = np.append(raw, np.zeros(2, dtype=np.uint8)).astype(np.uint32)
        b = padded[lead]
        for size, at in ((2, lead[b < 0xE0]), (3, lead[(b >= 0xE0) & (b < 0xF0)])):
            code = padded[at] & np.uint32(0x1F if size == 2 else 0x0F)
            for k in range(1, size):
                code = code << np.uint32(6) | padded[at + k] & np.uint32(63)
            for k in range(size):
                kind[np.minimum(at + k, n - 1)] = table[code]
    starts = np.empty(n, dtype=bool)
    starts[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    opens = np.zeros(n + 2, dtype=bool)
    opens[docs], opens[n:] = True, True
    # of white space before other characters the last one is apart, a blank goes with what follows
    after = np.flatnonzero(starts[1:] & (kind[:-1] == _SPACE) & ~opens[1:n]) + 1
    last = after - 1
    starts[last - (raw[last] >= 128)] = True
    starts[after[raw[last] == 32]] = False
    starts[docs] = True
    # an apostrophe that begins a piece, and letters that go with it
    at = np.flatnonzero((raw[:-1] == 39) & starts[:-1])
    at = at[~opens[at + 1]]
    one, two = raw[at + 1], np.append(raw, np.uint8(0))[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
    long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    long &= ~opens[at + 2]
    for chosen, size in ((short, 2), (long, 3)):
        starts[at[chosen] + 1] = False
        ends = at[chosen] + size
        starts[ends[ends < n]] = True
    return np.flatnonzero(starts), np.flatnonzero(kind == _ODD)


def split_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, pieces, whole), as of ``pieces_of`` with ``BYTE_LEVEL``, of (id, text, whether the tokenizer must split it)."""
    for b in batches:
        texts = b.column(1).cast(pa.string())
        data = texts.buffers()[2]
        off = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        row = 0
        while row < b.num_rows:
            end = max(row + 1, int(np.searchsorted(off, off[row] + SPAN, side="right")) - 1)
            own = off[row : end + 1] - off[row]
            size, whole = int(own[-1]), b.column(2).slice(row, end - row).to_numpy(zero_copy_only=False).copy()
            at, upto, pieces = np.empty(0, dtype=np.int64), np.zeros(end - row + 1, dtype=np.int64), pa.array([], type=pa.string())
            if size:
                raw = np.frombuffer(data, dtype=np.uint8, count=size, offset=int(off[row]))
                at, odd = piece_starts(raw, own[:-1][np.diff(own) > 0])
                whole[np.searchsorted(own, odd, side="right") - 1] = True
                ends = pa.py_buffer((np.append(at, size) + off[row]).astype(np.int32))
                pieces, upto = pa.StringArray.from_buffers(len(at), ends, data), np.searchsorted(at, own)
            if whole.any():
                number = np.where(whole, 0, np.diff(upto))
                pieces = pieces.filter(pa.array(np.repeat(~whole, np.diff(upto))))
                upto = np.concatenate([[0], np.cumsum(number)])
            lists = pa.ListArray.from_arrays(pa.array(upto, type=pa.int32()), pieces)
            some = texts.take(pa.array(np.arange(row, end), mask=~whole))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(row, end - row), lists, some], names=["id", "pieces", "whole"])
            row = end


def pieces_of(docs: DataFrame, pattern: str | None, doc_id: str, text: str, split: Column | None = None, added: list[str] | None = None) -> DataFrame:
    """(id, pieces, whole): pieces of the text by ``pattern`` (or by ``split``, an array
    expression over ``text``); ``whole`` has the texts that the tokenizer must split, such as those that hold one of
    its ``added`` tokens. A text of as many bytes as characters is ASCII and needs no look at its characters."""
    src = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text"))
    if split is not None:
        return src.select("id", split.alias("pieces"), F.lit(None).cast("string").alias("whole"))
    odd = (F.octet_length("text") != F.length("text")) & F.col("text").rlike(f"[^{KNOWN}]")
    for token in added or []:
        odd = odd | F.col("text").contains(token)
    found = F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0))
    none = F.array().cast("array<string>")
    return src.select("id", F.when(odd, none).otherwise(found).alias("pieces"), F.when(odd, F.col("text")).alias("whole"))


def encoded(batches: Iterator[pa.RecordBatch], store: Store, whole: Callable[[str], list] | None) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids of the rows, their token ids one after the other, offsets of each row) for
    runs of rows with about ``STEP`` pieces."""
    for b in batches:
        off = b.column(1).offsets.to_numpy().astype(np.int64)
        row = 0
        while row < b.num_rows:
            end = max(row + 1, int(np.searchsorted(off, off[row] + STEP, side="right")) - 1)
            part = b.slice(row, end - row)
            pieces = b.column(1).values.slice(int(off[row]), int(off[end] - off[row])).dictionary_encode()
            number = store.numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy(zero_copy_only=False)]
            size = store.size[number]
            tokens = gather(store.pool, store.start[number], size)
            upto = np.concatenate([[0], np.cumsum(size)])[off[row : end + 1] - off[row]]
            texts = part.column(2)
            if texts.null_count < len(texts):
                docs = np.split(tokens, upto[1:-1])
                for i, t in enumerate(texts.to_pylist()):
                    if t is not None:
                        docs[i] = np.array(whole(t), dtype=np.uint32)
                tokens = np.concatenate(docs)
                upto = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
            yield part.column(0), tokens, upto
            row = end
