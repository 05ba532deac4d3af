"""License scans: planted notices, alignments by brute force on small cases."""

from functools import lru_cache

import numpy as np

from notchline.llm import license_patience as L

DOCS = "doc_id long, text string, licenses string, pieces int"


def longest_common(a, b):
    @lru_cache(None)
    def go(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + go(i + 1, j + 1) if a[i] == b[j] else max(go(i + 1, j), go(i, j + 1))

    return go(0, 0)


def test_alignments_are_common_subsequences_and_whole_where_words_are_unique():
    rng = np.random.default_rng(1)
    for _ in range(500):
        a, b = (tuple(rng.choice(list("abcdefgh"), rng.integers(0, 12)).tolist()) for _ in range(2))
        got = L.align(list(a), list(b))
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
        if len(set(a)) == len(a) and len(set(b)) == len(b):
            assert len(got) == longest_common(a, b)
    assert L.align(list("aaaa"), list("aa")) and L.align([], ["x"]) == []


def test_the_candidate_bound_loses_no_occurrence():
    rng = np.random.default_rng(2)
    s = L.Scanner({"t": "the cat and the dog sat on a red mat"}, 0.8)
    for _ in range(400):
        words = rng.choice(["x", "y", "the", "a", "on"], rng.integers(0, 60)).tolist()
        template = list(s.words[0])
        if rng.random() < 0.6:
            for _ in range(int(rng.integers(0, 3))):
                k = int(rng.integers(0, len(template)))
                template[k : k + 1] = [] if rng.random() < 0.5 else ["z"]
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = template
            missing = 10 - longest_common(tuple(template), tuple(s.words[0]))
            masks = np.array([s.mask.get(w, 0) for w in words], dtype=np.int64)
            regions = list(s.candidates(masks, np.full(len(words), len(words))))
            if missing <= 2:
                assert any(x <= at + 9 and y >= at for _, x, y in regions)


def test_documents(spark):
    rng = np.random.default_rng(5)
    noise = lambda n: " ".join(rng.choice(["the", "of", "lorem", "software", "is", "version", "ipsum", "in", "license"], n))
    t = L.TEMPLATES
    gpl = "This work is licensed under\n the GNU General Public License;\n  VERSION 3."
    rows = [
        (0, noise(60) + "\n" + t["Apache-2.0"] + ".\n" + noise(60)),
        (1, gpl + " " + noise(10) + " " + gpl),
        (2, noise(400)),
        (3, None),
        (4, ""),
        (None, t["MIT"]),
        (5, noise(20) + t["MIT-text"].replace("obtaining", "getting").replace(" Software", " Program", 1) + noise(3)),
        (6, noise(20000) + " zz " + t["CC-BY-NC-4.0"] + " zz " + noise(10)),
        (0, t["BSD-2-text"]),
        (7, "Released under the BSD License"),
    ]
    got = L.scan_licenses(spark.createDataFrame([(*r, "c", 1) for r in rows], DOCS)).collect()
    names = sorted((r.id is None, r.id or 0, [x.license for x in r.licenses], r.n_hits) for r in got)
    want = [(0, ["Apache-2.0"]), (1, ["GPL-3.0"] * 2), (2, []), (3, []), (4, []), (5, ["MIT-text"]), (6, ["CC-BY-NC-4.0"]), (0, ["BSD-2-text"]), (7, [])]
    assert names == sorted([(False, d, x, len(x)) for d, x in want] + [(True, 0, ["MIT"], 1)])
    for r in got:
        text = L.words(dict(x[:2] for x in rows)[r.id]) if r.id in (1, 6) else None
        for x in r.licenses:
            assert 0.85 <= x.coverage <= 1
            if text:
                assert text[x.start : x.end] == L.words(t[x.license])
    assert next(r for r in got if r.id == 6).licenses[0].start == 20001


def test_empty_table(spark):
    assert L.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []


def slow_align(a, b, i=0, j=0):
    """Patience alignment as defined, recursively: equal ends, then the unique common words in rising order."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(i, j), *slow_align(a[1:], b[1:], i + 1, j + 1)]
    if a[-1] == b[-1]:
        return [*slow_align(a[:-1], b[:-1], i, j), (i + len(a) - 1, j + len(b) - 1)]
    both = [(x, b.index(w)) for x, w in enumerate(a) if a.count(w) == 1 == b.count(w)]
    best = [[]]  # all rising subsequences of the greatest length
    for p in both:
        best += [[*q, p] for q in best if not q or q[-1][1] < p[1]]
    most = max(map(len, best))
    if not most:
        return []
    out = []
    for chain in [q for q in best if len(q) == most]:
        edges = [(-1, -1), *chain, (len(a), len(b))]
        got = [(i + x, j + y) for x, y in chain]
        for (x, y), (u, v) in zip(edges, edges[1:], strict=False):
            got += slow_align(a[x + 1 : u], b[y + 1 : v], i + x + 1, j + y + 1)
        out.append(sorted(got))
    if len(out) > 1:
        raise LookupError("several chains of the greatest length")
    return out[0]


def test_alignment_equals_the_definition():
    rng = np.random.default_rng(9)
    same = 0
    for _ in range(1500):
        a, b = (rng.choice(list("abcdefghij"), rng.integers(0, 11)).tolist() for _ in range(2))
        try:
            want = slow_align(a, b)
        except LookupError:  # any of them is a patience alignment
            continue
        same += 1
        assert L.align(a, b) == sorted(want)
    assert same > 700


def test_scan_equals_a_scan_of_the_whole_text(spark):
    """Candidate regions and bit masks against every template tried on whole texts; more templates than a row of bits."""
    rng = np.random.default_rng(12)
    vocab = [f"w{i}" for i in range(30)]
    templates = {f"t{k:03}": " ".join(rng.choice(vocab, rng.integers(3, 12))) for k in range(150)}
    rows = []
    for i in range(60):
        ws = rng.choice(vocab, rng.integers(0, 50)).tolist()
        for _ in range(rng.integers(0, 3)):
            at = int(rng.integers(0, len(ws) + 1))
            ws[at:at] = templates[f"t{int(rng.integers(0, 150)):03}"].split()
        rows.append((i, " ".join(ws), "c", 1))
    s = L.Scanner(templates, L.COVERAGE)
    want = {}
    for i, text, *_ in rows:
        found = [(k, x, y, c) for k in range(150) for x, y, c in s.hits(k, text.split())]
        kept = []
        for k, x, y, c in sorted(found, key=lambda h: (-round(h[3] * len(s.words[h[0]])), -h[3], s.names[h[0]], h[1])):
            if all(y <= x2 or y2 <= x for _, x2, y2, _ in kept):
                kept.append((k, x, y, c))
        want[i] = sorted((x, y, s.names[k], round(c, 9)) for k, x, y, c in kept)
    got = L.scan_licenses(spark.createDataFrame(rows, DOCS), templates=templates).collect()
    assert {r.id: sorted((x.start, x.end, x.license, round(x.coverage, 9)) for x in r.licenses) for r in got} == want
    assert sum(map(len, want.values())) > 60
    assert {x.license for r in got for x in r.licenses} & {f"t{k:03}" for k in range(124, 150)}
