"""SimHash near-dedup against a brute-force version on small tables."""

import numpy as np
import pytest
import xxhash

from notchline.llm import simhash_anchor as S

TYPES = "doc_id long, text string, u string, fp string"


def slow_fp(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    k = min(4, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), seed=42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_anchors_cover_every_pair_of_halves_within_two_bits():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**32, 3000, dtype=np.uint32)
    x[:3] = (0, 0xFFFFFFFF, 0x80000000)
    y = x.copy()
    for _ in range(2):
        y ^= np.uint32(1) << rng.integers(0, 33, 3000).astype(np.uint32) % np.uint32(32)
    a, b = S.anchors(x), S.anchors(y)
    left = set(zip(a[0].tolist(), a[1].tolist(), strict=True))
    right = set(zip(b[0].tolist(), b[1].tolist(), strict=True))
    assert {i for i, _ in left & right} == set(range(3000))


def _linked(spark, fps, chunk):
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    cc = S.connected_components(S.links(df, chunk=chunk), "u", "v").collect()
    return {r.node: r.root for r in cc}


@pytest.mark.parametrize("chunk", [4096, 7])
def test_links_match_brute_force_with_and_without_split_anchors(spark, chunk):
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63, 12, dtype=np.int64)
    fps = set(base.tolist())
    for b in base[:4].tolist():
        for _ in range(40):
            f = b
            for k in rng.integers(0, 64, rng.integers(1, 7)):
                f = int(np.int64(np.uint64(f & (2**64 - 1)) ^ np.uint64(1 << int(k))))
            fps.add(f)
    fps = sorted(fps)
    mask = 2**64 - 1
    root = {f: f for f in fps}
    for _ in range(len(fps)):
        before = dict(root)
        for f in fps:
            root[f] = min(root[g] for g in fps if ((f & mask) ^ (g & mask)).bit_count() <= 4)
        if before == root:
            break
    got = _linked(spark, fps, chunk)
    assert {f: got.get(f, f) for f in fps} == root


def test_groups_match_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(60):
        words = list(rng.choice(vocab, rng.integers(1, 120)))
        rows.append((i, " ".join(words)))
        rows.append((100 + i, "\t".join(words).upper()))
        words[0] = "other"
        rows.append((200 + i, " ".join(words)))
    long = " ".join(rng.choice(vocab, 30000))
    rows += [(300, None), (301, ""), (302, " \n "), (303, long), (304, long + " tail"), (None, "w1 w2"), (305, "w1 w2"), (305, "w1 w2"), (306, "É é x")]
    df = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], TYPES)
    got = S.simhash_groups(df).select("id", S.hex_of().alias("f"), "component").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(slow_groups(rows), key=key)


def slow_groups(rows):
    with_id = [(r[0], r[1]) for r in rows]
    out = []
    fps = [slow_fp(t) for _, t in with_id]
    n = len(fps)
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for i in range(n):
            root[i] = min(root[j] for j in range(n) if (fps[i] ^ fps[j]).bit_count() <= 4)
        if before == root:
            break
    for i in range(n):
        ids = [with_id[j][0] for j in range(n) if root[j] == root[i] and with_id[j][0] is not None]
        out.append((with_id[i][0], f"{fps[i]:016x}", min(ids) if ids else None))
    return out


def test_empty_table(spark):
    assert S.simhash_groups(spark.createDataFrame([], TYPES)).collect() == []
