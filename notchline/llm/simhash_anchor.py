"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at ``max_bits`` = 4 or fewer differing bits.

Covering. Of two linked fingerprints, one 32-bit half differs in at most 2 bits.
Each half is covered by the code Hamming[31,26] x {0,1}: a perfect code of covering
radius 1 on 31 bits, the last bit taken as it is; its 2^27 codewords are the
anchors of that half. A fingerprint is replicated to every anchor within the
covering radius plus its share of the half's threshold: the two halves x, y of a
linked pair have a point z that differs from each in at most one bit, z has an anchor within
radius 1, so that anchor is within 1 + 1 of both x and y. That is 17 anchors at
most for each half (16 codewords within 2 bits, one with the last bit flipped).

Comparison. Rows of an anchor are compared with each other by XOR and bit count;
what leaves an anchor is a spanning star for each connected set of it, never all its pairs.
An anchor of over ``CHUNK`` rows is dealt over several tasks: its rows fall into
chunks, and each chunk meets its own rows and those of the later chunks, which
stream past. Components follow over distinct fingerprints only, so a group of
exact copies is one node however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline.llm.common import id_text_key, stored, table, text_of, tidy, without
from notchline.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
CHUNK = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> bytes:
    """The 8 bytes (most significant first) of a text's SimHash."""
    words = text.lower().split()  # on bytes: A-Z only, and \\x20 \\x09-\\x0D only
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends.tolist()
    k = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :], strict=False)])
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int32) > len(bits)).tobytes()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every row's whole text as a signed long. A null
    or blank text has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b"".join([fingerprint(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.frombuffer(fps, dtype=">i8").astype("<i8"))], names=["id", "fp"])

    src = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text"))
    return src.mapInArrow(tidy(run), T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("fp", T.LongType())]))


def _error_patterns() -> np.ndarray:
    """By syndrome s (0 to 31): the 31-bit error words of weight 2 or less whose
    syndrome is s, filled up with the first to 16. Bit p - 1 is position p."""
    out = np.zeros((32, 16), dtype=np.uint32)
    for s in range(1, 32):
        pairs = [(1 << p - 1) | (1 << (p ^ s) - 1) for p in range(1, 32) if p < p ^ s]
        out[s] = [1 << s - 1, *pairs]
    return out


_ERRORS = _error_patterns()


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``half``, anchor) for every anchor that a 32-bit half goes to."""
    low = half & np.uint32(0x7FFFFFFF)
    syndrome = np.zeros(len(half), dtype=np.uint32)
    for p in range(1, 32):
        syndrome ^= ((low >> np.uint32(p - 1)) & np.uint32(1)) * np.uint32(p)
    near = half[:, None] ^ _ERRORS[syndrome]
    flipped = near[:, :1] ^ np.uint32(0x80000000)  # the home codeword, last bit flipped
    at = np.repeat(np.arange(len(half)), 17).reshape(-1, 17)
    keep = np.ones(at.shape, dtype=bool)
    keep[syndrome == 0, 1:16] = False  # a codeword has no other within 2 bits
    return at[keep], np.concatenate([near, flipped], axis=1)[keep]


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, 8192):
            fp = b.column(0).slice(k, 8192).to_numpy(zero_copy_only=False)
            u = fp.view(np.uint64)
            for block, half in enumerate(((u >> np.uint64(32)).astype(np.uint32), (u & np.uint64(0xFFFFFFFF)).astype(np.uint32))):
                at, anchor = anchors(half)
                key = anchor.astype(np.int64) | np.int64(block << 32)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at])], names=["anchor", "fp"])


def _near(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= bits


def linked_sets(fps: np.ndarray, bits: int, step: int = 256) -> np.ndarray:
    """For each of ``fps`` (unsigned) the index of the first member of its connected set."""
    label = np.arange(len(fps))
    changed = len(fps) > step or int(_near(fps, fps, bits).sum()) > len(fps)  # most sets hold nothing near
    while changed:
        changed = False
        for k in range(0, len(fps), step):
            low = np.where(_near(fps[k : k + step], fps, bits), label[None, :], len(fps)).min(axis=1)
            if (low < label[k : k + step]).any():
                label[k : k + step] = np.minimum(low, label[k : k + step])
                changed = True
        label = label[label]
    return label


def _compare(bits: int):
    def edges_of(group: np.ndarray, later: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        label = linked_sets(group, bits)
        out = [(group[label != np.arange(len(group))], group[label[label != np.arange(len(group))]])]
        for rows in later:
            for k in range(0, len(rows), 256):
                i, j = np.nonzero(_near(rows[k : k + 256], group, bits))
                if len(i):
                    pair = np.unique(np.stack([i, label[j]], axis=1), axis=0)
                    out.append((rows[k + pair[:, 0]], group[pair[:, 1]]))
        return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])

    def batch(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by anchor, salt, role; the chunk (role 0) of the open group is held, later chunks stream
        key, chunk = None, np.empty(0, dtype=np.uint64)
        for b in batches:
            anchor, salt, role, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            fp = fp.view(np.uint64)
            new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])) + 1
            bounds = [0, *new.tolist(), len(fp)]
            found_u, found_v = [], []
            for s, e in zip(bounds, bounds[1:], strict=False):
                if s == e:
                    continue
                if (anchor[s], salt[s]) != key:
                    if len(chunk) > 1:
                        u, v = edges_of(chunk, [])
                        found_u.append(u)
                        found_v.append(v)
                    key, chunk = (anchor[s], salt[s]), np.empty(0, dtype=np.uint64)
                if e - s == 1 and not len(chunk):
                    chunk = fp[s:e]
                    continue
                own, others = fp[s:e][role[s:e] == 0], fp[s:e][role[s:e] == 1]
                chunk = np.concatenate([chunk, own]) if len(own) else chunk
                if len(others) and len(chunk):
                    u, v = edges_of(chunk, [others])
                    found_u.append(u)
                    found_v.append(v)
            if found_u:
                yield batch(np.concatenate(found_u), np.concatenate(found_v))
        if len(chunk) > 1:
            yield batch(*edges_of(chunk, []))

    return run


def links(fps: DataFrame, bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """(u, v) over distinct fingerprints ``fp``: enough pairs to connect whatever links
    of ``bits`` (4 at most) or fewer differing bits connect."""
    if not 0 <= bits <= 4:
        raise ValueError("the covering is built for links of 0 to 4 bits")
    return compare_placed(fps.select("fp").mapInArrow(tidy(_replicate), "anchor long, fp long"), bits, chunk)


def compare_placed(placed: DataFrame, bits: int, chunk: int = CHUNK) -> DataFrame:
    """(u, v): a spanning star of every set of fingerprints (anchor, fp) that links within an anchor."""
    hot = placed.groupBy("anchor").count().where(F.col("count") > chunk).select("anchor", F.ceil(F.col("count") / chunk).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), salts).cast("int")
    dealt = (
        placed.join(hot, "anchor", "left")
        .select("anchor", "fp", own.alias("own"), F.explode(F.sequence(own, salts - 1)).alias("salt"))
        .select("anchor", "salt", (F.col("salt") != F.col("own")).cast("int").alias("role"), "fp")
    )
    together = dealt.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "role")
    return together.mapInArrow(tidy(_compare(bits)), "u long, v long")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component): one row for each row of ``docs``; ``component`` is the
    smallest id that links reach, the row's own id included (null ids are
    passed over; null if the component has no other). Null and blank texts share
    fingerprint zero and link like any other; repeated rows keep their rows; an
    empty table gives an empty result; other columns are not read."""
    each = stored(fingerprints(docs, doc_id, text, shingle), "simhash")
    fps = each.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(links(fps, bits), "u", "v").withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    return each.join(rooted.select("fp", "root").join(lowest, "root").select("fp", "component"), "fp").select("id", "fp", "component")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without the near-duplicates: of every group the smallest id stays. Rows
    that repeat id and text stay once; rows without id go if their group has
    an id, and else stay once for each text."""
    keyed = docs.select(F.struct(F.col(doc_id).alias("id"), id_text_key(doc_id, text).alias("key")).alias("id"), F.col(text).alias("text"))
    groups = stored(simhash_groups(keyed, "id", "text", shingle, bits), "simhash-groups")
    # the smallest (id, key) of a group; a null id sorts first, so ids are compared apart from it
    rows = groups.select(F.col("id.id").alias("id"), F.col("id.key").alias("key"), "component")
    lowest = rows.groupBy("component").agg(F.min("id").alias("low"))
    rows = stored(rows.join(lowest, "component").select("id", "key", "low"), "simhash-rows")
    kept = without(docs, rows.where("low is not null and not low <=> id").select("key"), id_text_key(doc_id, text))
    again = stored(rows.where("low <=> id").groupBy("key").count().where("count > 1").select("key"), "repeated-rows")
    if again.isEmpty():
        return kept
    repeated = without(kept, again, id_text_key(doc_id, text), "left_semi").dropDuplicates([doc_id, text])
    return without(kept, again, id_text_key(doc_id, text)).union(repeated)


def hex_of(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def op8_simhash_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash_groups(table(spark, sf_dir, "documents"))
    return g.select(F.col("id").alias("doc_id"), hex_of().alias("fingerprint"), F.col("component").alias("component_id"))


QUERIES = {"op8_simhash_anchor": op8_simhash_anchor}
ORACLE: dict[str, str] = {}
