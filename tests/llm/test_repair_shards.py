"""Re-Pair shards: exact round trip, random access, digests by brute force."""

import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from notchline.llm import pretokens
from notchline.llm import repair_shards as R
from notchline.llm.pretokens import Store

from .test_bpe_backtrack import ODD

PATH = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n,k", [(0, 5), (1, 5), (17, 2), (5000, 1), (5000, 3), (60000, 50), (60000, 70000)])
def test_round_trip_and_runs(n, k):
    rng = np.random.default_rng(n + k)
    ids = (rng.zipf(1.3, n) % k).astype(np.uint32)
    base = max(k, 1)
    seq, left, right, rounds = R.compress(ids, base)
    assert (R.expand(seq, left, right, rounds, base) == ids).all() and (left < base + len(left)).all()
    lengths = R.lengths_of(left, right, rounds, base)
    for i in range(0, len(left), max(1, len(left) // 50)):
        assert lengths[i] == len(R.expand(np.array([base + i], dtype=np.uint32), left, right, rounds, base))
    shard = R.Shard(len(seq), base, R._pack(seq), *(x.astype("<u4").tobytes() for x in (left, right, rounds, lengths)))
    assert (shard.all() == ids).all()
    for s, e in [(0, 0), (0, n), *((a, min(n, a + 37)) for a in range(0, n, max(1, n // 30)))]:
        assert (shard.run(s, e) == ids[s:e]).all()
    if k == 1:
        assert len(seq) < n / 8


@pytest.mark.parametrize("shard", [R.SHARD, 40])
def test_documents(spark, tmp_path, shard):
    tok = Tokenizer.from_file(PATH)
    texts = [*ODD, "<|endoftext|> x", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext", *(f"some words and number {i} " * (i % 40) for i in range(200))]
    rows = [(i * 3, t, 5) for i, t in enumerate(texts)] + [(-4, None, 5), (None, "null id", 5), (9, "tie a", 5), (9, "tie a", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(5)
    out = str(tmp_path / "shards")
    R.write_shards(df, out, PATH, P.PATTERN, shard=shard)
    got = sorted(((r.id is not None, r.id or 0, r.start, r.n_tokens, r.ids_crc32) for r in R.read_documents(spark, out).collect()), key=lambda r: r[2])
    want, start = [], 0
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((d is not None, d or 0, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == want
    some = spark.createDataFrame([(3,), (9,), (60,), (777,)], "id long")
    runs = sorted((r.id, r.ids) for r in R.read_runs(spark, out, some).collect())
    assert runs == sorted((d, tok.encode(t, add_special_tokens=False).ids + [0]) for d, t, _ in rows if d in (3, 9, 60, 777))


def test_empty_table(spark, tmp_path):
    out = str(tmp_path / "none")
    R.write_shards(spark.createDataFrame([], "doc_id long, text string"), out, PATH, P.PATTERN)
    assert R.read_documents(spark, out).collect() == []


def test_no_pair_is_left_that_occurs_often():
    rng = np.random.default_rng(6)
    words = [rng.integers(0, 300, 40) for _ in range(30)]
    for ids in (np.concatenate([words[i] for i in rng.integers(0, 30, 900)]), np.tile(np.arange(50), 400), np.zeros(5000, dtype=np.int64), rng.integers(0, 9, 30000)):
        seq, left, right, rounds = R.compress(ids.astype(np.uint32), 300)
        assert (R.expand(seq, left, right, rounds, 300) == ids).all()
        pairs, n = np.unique(np.stack([seq[:-1], seq[1:]]), axis=1, return_counts=True)
        apart = pairs[0] != pairs[1]  # of a run of one symbol every second place can be replaced
        assert not len(n) or n[apart].max(initial=0) < R.LEAST and n[~apart].max(initial=0) < 2 * R.LEAST


def test_one_id_is_dealt_over_many_tasks(spark, tmp_path):
    out = str(tmp_path / "hot")
    rows = [(None if i % 2 else 7, f"text {i % 5} " * 20) for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        R.write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), out, PATH, P.PATTERN)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r.n for r in spark.read.parquet(out).selectExpr("part", "size(doc_ids) AS n").groupBy("part").sum("n").withColumnRenamed("sum(n)", "n").collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500
    got = sorted((r.start, r.n_tokens, r.id) for r in R.read_documents(spark, out).collect())
    assert len(got) == 4000 and [r[2] for r in got] == [None] * 2000 + [7] * 2000
    assert all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:], strict=False))


def test_rounds_look_at_rare_pairs_once(monkeypatch):
    """Every round went over the whole sequence; pairs too rare to be replaced stay so until a neighbour is."""
    rng = np.random.default_rng(8)
    words = [rng.integers(0, 20000, rng.integers(2, 9)) for _ in range(3000)]
    ids = np.concatenate([np.append(words[i % 3000], j % 20000) for j, i in enumerate(rng.zipf(1.2, 20000))]).astype(np.uint32)
    looked = []
    for name in ("_by_hash", "_by_sort"):
        monkeypatch.setattr(R, name, lambda a, *rest, _do=getattr(R, name): looked.append(len(a)) or _do(a, *rest))
    seq, left, right, rounds = R.compress(ids, 20000)
    assert (R.expand(seq, left, right, rounds, 20000) == ids).all() and len(rounds) > 5
    assert sum(looked) < 3.5 * len(ids)


def test_store_keeps_the_pieces_met_often():
    """A full store was emptied, and frequent pieces were encoded again each time."""
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        sizes = np.array([len(p) for p in pieces])
        return np.frombuffer("".join(pieces).encode(), dtype=np.uint8).astype(np.uint32), sizes

    store = Store(encode)
    store.limit = 20000
    for i in range(100):
        pieces = ["the", "of", *(f"rare{i}-{k}" for k in range(20)), ""]
        number = store.numbers(pieces)
        got = [bytes(store.pool[s : s + n].astype(np.uint8)).decode() for s, n in zip(store.start[number], store.size[number], strict=True)]
        assert got == pieces and store.held < 2 * store.limit
    assert asked.count("the") == 1


def test_texts_are_split_side_by_side(spark, tmp_path, monkeypatch):
    """Each piece was cut by itself in the JVM and copied out of its text."""
    rng = np.random.default_rng(11)
    parts = ["'", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'S", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "a", "Zé", "ll", "e", "rest", "7", "²", "½", "_", "!", "--", "…", "“", "漢字", "かな", "カ", "", "ª", "x\u00ad", "\x00"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(4000)] + [c for c in parts if c]
    odd = ["Ж", "a 😀 b", "e\u0301", "\u2028", "ab\uffff", " \u202f"]
    rows = [(i, t, False) for i, t in enumerate(texts + odd)] + [(-1, "as is", True), (-2, "", True)]
    rows = [rows[i] for i in rng.permutation(len(rows)).tolist()]
    pattern = regex.compile(P.PATTERN)
    for span, step in ((1 << 21, 5000), (300, 1000), (1, 1000)):
        monkeypatch.setattr(pretokens, "SPAN", span)
        batches = (pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*rows[k : k + step], strict=True), (pa.int64(), pa.string(), pa.bool_()), strict=True)], names=["id", "text", "whole"]).slice(3) for k in range(0, len(rows), step))
        got = {r["id"]: (r["pieces"], r["whole"]) for b in pretokens.split_texts(batches) for r in b.to_pylist()}
        want = {i: ([], t) if whole or t in odd else (pattern.findall(t), None) for k in range(0, len(rows), step) for i, t, whole in rows[k + 3 : k + step]}
        assert got == want
    seen = []
    monkeypatch.setattr(R, "pieces_of", lambda *a, **b: seen.append(a) or pretokens.pieces_of(*a, **b))
    R.write_shards(spark.createDataFrame(rows, "doc_id long, text string, whole boolean"), str(tmp_path / "x"), PATH, P.PATTERN)
    R.write_shards(spark.createDataFrame(rows, "doc_id long, text string, whole boolean"), str(tmp_path / "y"), PATH, f"(?:{P.PATTERN})")
    assert len(seen) == 1
    assert R.read_documents(spark, str(tmp_path / "x")).orderBy("id").collect() == R.read_documents(spark, str(tmp_path / "y")).orderBy("id").collect()


def test_a_piece_is_looked_up_once_a_run():
    """The store was searched twice for each piece."""
    looked = []

    class Seen(dict):
        def get(self, key, other=None):
            looked.append(key)
            return super().get(key, other)

        def __contains__(self, key):
            looked.append(key)
            return super().__contains__(key)

        def __getitem__(self, key):
            looked.append(key)
            return super().__getitem__(key)

    store = Store(lambda pieces: (np.array([len(p) for p in pieces], dtype=np.uint32), np.ones(len(pieces), dtype=np.int64)))
    store.at = Seen()
    texts = pa.array([f"some words {i % 7} here " * 100 for i in range(400)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), texts, pa.array([False] * 400)], names=["id", "text", "whole"])
    got = [tokens for _, tokens, _ in pretokens.encoded(pretokens.split_texts(iter([batch])), store, None)]
    assert len(got) == 1 and got[0].sum() == sum(map(len, texts.to_pylist())) and len(looked) == len(set(looked))
