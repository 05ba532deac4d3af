"""Preference formatting against a brute-force version."""

from collections import defaultdict

import numpy as np

from notchline.llm import preference_chat as C

TURNS = "pair_id long, turn long, role string, text string, side int, segment string"
LOW = -(2**63)


def slow(chosen, rejected):
    sides = [defaultdict(lambda: defaultdict(set)) for _ in range(2)]
    for k, rows in enumerate((chosen, rejected)):
        for p, t, r, x in rows:
            if p is not None:
                sides[k][p][LOW if t is None else t].add((r or "", x or ""))
    out = []
    for p in set(sides[0]) | set(sides[1]):
        a, b = sides[0].get(p, {}), sides[1].get(p, {})
        differ = [t for t in set(a) | set(b) if a.get(t) != b.get(t)]
        m = min(differ, default=None)
        status = "chosen only" if not b else "rejected only" if not a else "same" if m is None else "pair"
        for name, side in (("prompt", a), ("chosen", a), ("rejected", b)):
            for t, rows in side.items():
                if (m is None or t < m) == (name == "prompt"):
                    out += [(p, name, t, r, f"<|im_start|>{r}\n{x}<|im_end|>\n", name == "prompt" or r != "assistant", status) for r, x in rows]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    chosen, rejected = [], []
    for p in range(60):
        n = int(rng.integers(1, 9))
        base = [(p, t * int(rng.integers(1, 3)) if p % 7 == 0 else t, ("user", "assistant")[t % 2], str(rng.choice(["yes", "no", "é\nlong", ""]))) for t in range(n)]
        cut = int(rng.integers(0, n + 1))
        other = base[:cut] + [(p, t, r, x + str(rng.choice(["", "!"]))) for _, t, r, x in base[cut:]]
        chosen += base
        rejected += other[: int(rng.integers(max(1, n - 2), n + 1))]
    chosen += [(100, 0, "user", "alone"), (102, None, None, None), (102, 1, "assistant", "x" * 200000), (None, 0, "user", "no pair"), chosen[0], chosen[0]]
    rejected += [(101, 0, "user", "alone"), (102, None, None, None), (102, 1, "assistant", "y")]
    c, r = (spark.createDataFrame([(*x, 9, "s") for x in rows], TURNS) for rows in (chosen, rejected))
    turns = C.preference_turns(c, r)
    assert sorted(map(tuple, turns.collect())) == slow(chosen, rejected)
    whole = {(x.pair_id, x.part): x for x in C.rendered(turns).collect()}
    by = defaultdict(list)
    for x in slow(chosen, rejected):
        by[x[0], x[1]].append(x)
    assert set(whole) == set(by)
    for k, rows in by.items():
        rows.sort(key=lambda x: (x[2], x[3], x[4]))
        assert whole[k].text == "".join(x[4] for x in rows)
        trained = "".join(whole[k].text[s.start : s.start + s.length] for s in whole[k].trained)
        assert trained == "".join(x[4] for x in rows if not x[5])


def test_empty_tables(spark):
    none = spark.createDataFrame([], TURNS)
    assert C.preference_turns(none, none).collect() == []
