"""Byte-level BPE encoding by backtracking over longest matches, and decoding.

Bytes are mapped to Latin-1 characters so that pyahocorasick can enumerate every
vocabulary token in a pre-token in one pass. The encoder takes the longest token at
the current position; if that token cannot stand beside the token before it, or the place
after it is known to lead nowhere, it takes the next shorter token, and with none
left steps back over the last token and marks the place. Every place fails at most
once, so the work is linear in the length of the pre-token (times the
bounded number of tokens at a place).

Two tokens can stand side by side in a BPE result exactly if merging the bytes of
both gives back these two. ``Merges.beside`` decides it by undoing merges at the
seam from the latest to the earliest, looking for a merge across the seam that would
have come before; its answers are remembered, in bounded memory.

Ranks are those of a tiktoken file, one token for each of the 256 bytes included.
Every distinct pre-token of a batch is encoded once (pretokens.py).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from notchline.llm.common import table, tidy
from notchline.llm.pretokens import Store, encoded, flat, gather, pieces_of

REMEMBERED = 250_000  # pairs, of about 150 bytes each


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """Everything that encoding needs of a rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        #: rank -> (left, right) that merge into it; a byte has none
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                left, right = self._last_merge(token, rank)
                self.parts[rank] = (left, right)
                self.merged[left, right] = rank
        self.known: dict[int, bool] = {}

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens left of ``token`` when all merges of a lower rank are done."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min((self.ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] >= rank:
                raise ValueError(f"token {token!r} is not a merge of two tokens of lower rank")
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def beside(self, left: int, right: int) -> bool:
        key = left << 32 | right
        if (known := self.known.get(key)) is None:
            known = self._beside(left, right)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[key] = known
        return known

    def _beside(self, left: int, right: int) -> bool:
        # Going back in time: ``before`` is the moment (a rank, and whether the undone
        # merge was the one left of the seam) until which the two tokens at the seam
        # stood there. A merge of both must not come earlier. At equal rank the left one goes first.
        before = (float("inf"), 0)
        while True:
            across = self.merged.get((left, right))
            if across is not None and (across, 0.5) < before:
                return False
            undo_left, undo_right = left in self.parts, right in self.parts
            if not undo_left and not undo_right:
                return True
            if undo_left and (not undo_right or left > right):
                before = (left, 0)
                left = self.parts[left][1]
            else:
                before = (right, 1)
                right = self.parts[right][0]

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        at: list[list[tuple[int, int]]] = [[] for _ in piece]
        for last, (n, rank) in self.automaton.iter(piece.decode("latin-1")):
            at[last - n + 1].append((n, rank))  # by ascending length at each place
        out: list[tuple[int, int]] = []
        dead = bytearray(len(piece) + 1)
        pos, choice = 0, len(at[0]) - 1
        stack: list[int] = []
        while pos < len(piece):
            options, before = at[pos], out[-1][1] if out else None
            while choice >= 0:
                n, rank = options[choice]
                if not dead[pos + n] and (before is None or self.beside(before, rank)):
                    break
                choice -= 1
            if choice >= 0:
                out.append(options[choice])
                stack.append(choice)
                pos += options[choice][0]
                choice = len(at[pos]) - 1 if pos < len(piece) else 0
            else:
                dead[pos] = 1
                pos -= out.pop()[0]
                choice = stack.pop() - 1
        return [rank for _, rank in out]


class Codec:
    """Encoder and decoder of one rank file; built once in a Python worker."""

    _open: dict[str, Codec] = {}

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(load_ranks(path))
        self.pattern = regex.compile(pattern)
        self.store = Store(lambda pieces: flat([self.merges.encode(p.encode()) for p in pieces]))
        top = max(self.merges.bytes_of) + 1
        self.size = np.zeros(top, dtype=np.int64)
        for rank, token in self.merges.bytes_of.items():
            self.size[rank] = len(token)
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(self.merges.bytes_of.get(r, b"") for r in range(top)), dtype=np.uint8)

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        if path not in cls._open:
            cls._open[path] = cls(path, pattern)
        return cls._open[path]

    def whole(self, text: str) -> list[int]:
        return [i for p in self.pattern.findall(text) for i in self.merges.encode(p.encode())]

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, dtype=np.int64)
        return gather(self.pool, self.start[ids], self.size[ids]).tobytes()


def _id_field(docs: DataFrame, doc_id: str) -> T.StructField:
    return T.StructField("id", docs.schema[doc_id].dataType)


def encode_bpe(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): the token ids of every row's whole text as an array of int. Null and
    empty texts have no ids; repeated rows are encoded each; other columns are not read."""

    def run(batches: Iterable[pa.RecordBatch]):
        codec = Codec.of(path, pattern)
        for rows, ids, upto in encoded(batches, codec.store, codec.whole):
            lists = pa.ListArray.from_arrays(pa.array(upto, type=pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows, lists], names=["id", "ids"])

    schema = T.StructType([_id_field(docs, doc_id), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    return pieces_of(docs, pattern, doc_id, text).mapInArrow(tidy(run), schema)


def decode_bpe(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, data): the bytes of every row's ``ids``; null ids give no bytes."""

    def run(batches: Iterable[pa.RecordBatch]):
        codec = Codec.of(path, pattern)
        for b in batches:
            data = [codec.decode(x.values.to_numpy()) if x.is_valid else b"" for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, type=pa.binary())], names=["id", "data"])

    return rows.select("id", "ids").mapInArrow(tidy(run), T.StructType([_id_field(rows, "id"), T.StructField("data", T.BinaryType())]))


def bpe_digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, and ids if asked): encodes every whole
    text, decodes the ids again and digests both in the same pass, so no id list is shuffled."""
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches: Iterable[pa.RecordBatch]):
        codec = Codec.of(path, pattern)
        for rows, ids, upto in encoded(batches, codec.store, codec.whole):
            ids_of, decoded_of = [], []
            little = ids.astype("<u4")
            for s, e in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
                ids_of.append(hashlib.sha256(little[s:e]).hexdigest())
                decoded_of.append(hashlib.sha256(codec.decode(little[s:e])).hexdigest())
            columns = [rows, pa.array(np.diff(upto).astype(np.int64)), pa.array(ids_of, type=pa.string()), pa.array(decoded_of, type=pa.string())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(upto, type=pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = [docs.schema[doc_id].dataType, T.LongType(), T.StringType(), T.StringType(), *[T.ArrayType(T.IntegerType(), False)] * with_ids]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return pieces_of(docs, pattern, doc_id, text).mapInArrow(tidy(run), schema)


def op6_bpe_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    out = bpe_digests(table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


QUERIES = {"op6_bpe_backtrack": op6_bpe_backtrack}
ORACLE: dict[str, str] = {}
