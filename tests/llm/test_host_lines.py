"""Base counts and host line frequency against a brute-force version."""

import re
from collections import Counter, defaultdict

import numpy as np

from notchline.llm import host_lines as H

DOCS = "doc_id long, text string, source string, row long, host string, lines string"


def slow(rows, max_docs, max_share):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t)

    docs_of, ids_of, out = defaultdict(set), defaultdict(set), []
    for k, (d, t, s) in enumerate(rows):
        doc = ("row", k) if d is None else d
        ids_of[s or ""].add(doc)
        for line in (t or "").split("\n"):
            norm = " ".join(words(re.sub("[1-9]", "0", line.lower())))
            if norm:
                docs_of[s or "", norm].add(doc)
    for d, t, s in rows:
        t = t or ""
        w = words(t)
        win = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        cover = {i + k for i in range(len(w) - 7) if win[tuple(w[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in t.split("\n") if words(x)]
        most = max(max_docs, max_share * len(ids_of[s or ""]))
        gone = 0
        for x in lines:
            norm = words(re.sub("[1-9]", "0", x.lower()))
            if len(docs_of[s or "", " ".join(norm)]) > most:
                gone += len(norm)
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        kept = not failed and len(w) - gone >= 20 and 2 * gone <= len(w)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), gone, failed, kept))
    return out


def test_counts_and_verdicts_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    shared = [f"Shared line {i} of the host, all the same" for i in range(5)]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.integers(1, 8)):
            kind = rng.random()
            if kind < 0.3:
                lines.append(str(rng.choice(shared)).upper() if rng.random() < 0.3 else str(rng.choice(shared)))
            else:
                lines.append(" ".join(f"w{x}" for x in rng.integers(0, 400, rng.integers(0, 25))) + str(rng.choice(["", " #", "\t", "  *", "é|"])))
        if rng.random() < 0.3:
            lines += [lines[0]] * int(rng.integers(1, 4))
        rows.append((i, "\n".join(lines), f"s{i % 3}"))
    rows += [(200, None, "s0"), (201, "", "s0"), (202, " \n\t", None), (None, "x " * 40, "s1"), (None, "x " * 40, "s1"), (5, rows[5][1], rows[5][2])]
    rows += [(203, " ".join(f"u{i}" for i in range(30000)), "s2"), (204, "a b c d e f g h " * 3, "s2"), (205, "a\x0bb\x0cc\rd \x1ce\xa0f", "s2")]
    df = spark.createDataFrame([(*r, 7, "z", "q") for r in rows], DOCS)
    for max_docs, share in ((10, 0.001), (2, 0.2)):
        got = [tuple(r) for r in H.host_line_rules(df, max_docs=max_docs, max_share=share).collect()]
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(got, key=key) == sorted(slow(rows, max_docs, share), key=key)


def test_empty_table(spark):
    assert H.host_line_rules(spark.createDataFrame([], DOCS)).collect() == []
