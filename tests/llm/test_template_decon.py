"""Template decontamination against a brute-force version."""

import re
from collections import defaultdict

import numpy as np

from notchline.llm import template_decon as D

ITEM = "Tom has 12 apples and buys 30 more apples at the market for 5 dollars, then Tom gives 7 apples to Anna before they walk 3 km home"
DOCS = "doc_id long, text string, item_id long, h string, tokens string"
BENCH = "item_id long, text string, h string"


def tokens(text):
    return [t for t in re.findall(r"[^\W\d_]+|[0-9]+(?:[.,:/][0-9]+)*|[%$€£]", text or "")]


def codes(ts):
    num = [t[0] in "0123456789" for t in ts]
    out = []
    for i, t in enumerate(ts):
        beside = (i > 0 and num[i - 1]) or (i + 1 < len(ts) and num[i + 1])
        out.append(1 if num[i] else 2 if t.lower() in D.UNITS and beside else 3 if t.lower() != t else t.lower())
    return out


def slow(rows, bench):
    items = defaultdict(list)
    for i, t in bench:
        if len(tokens(t)) >= D.WINDOW:
            items[tuple(tokens(t))].append(i)
    out = []
    for d, t in rows:
        ts = tokens(t)
        cs, found, most = codes(ts), set(), 0
        at = defaultdict(list)
        for p in range(len(cs) - D.WINDOW + 1):
            at[tuple(cs[p : p + D.WINDOW])].append(p)
        for it, ids in items.items():
            ic = codes(it)
            shifts = defaultdict(list)
            for q in range(len(ic) - D.WINDOW + 1):
                win = tuple(ic[q : q + D.WINDOW])
                if sum(c not in (1, 2, 3) for c in win) >= D.LITERAL:
                    for p in at[win]:
                        shifts[p - q].append(q)
            for s, qs in shifts.items():
                inside = sorted({q + k for q in qs for k in range(D.WINDOW)})
                if len(inside) < min(D.COVER, len(ic)):
                    continue
                pairs = {(ic[q], it[q].lower(), ts[q + s].lower()) for q in inside if ic[q] in (1, 2, 3)}
                if len({x[:2] for x in pairs}) == len(pairs) == len({(x[0], x[2]) for x in pairs}):
                    found |= set(ids)
                    most = max(most, len(inside))
        out.append((d, bool(found), len(found), most, sorted(found)))
    return out


def check(spark, rows, bench):
    df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], DOCS)
    b = spark.createDataFrame([(i, t, "z") for i, t in bench], BENCH)
    got = [tuple(r) for r in D.contaminated(df, b).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = slow(rows, bench)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = D.drop_contaminated(df, b)
    assert kept.columns == df.columns and kept.count() == sum(not r[1] for r in want)
    return {r[0]: r for r in got}


def test_planted_variants_and_noise(spark, monkeypatch):
    rng = np.random.default_rng(7)
    noise = lambda n: " ".join(f"{'qwertz'[a]}{'aeiou'[b]}{'lmnrs'[c]}" for a, b, c in zip(rng.integers(0, 6, n), rng.integers(0, 5, n), rng.integers(0, 5, n), strict=True))
    other = ITEM.replace("12", "450").replace("30", "8.5").replace("Tom", "Maria").replace("Anna", "Bert").replace("km", "miles").replace("7", "61")
    broken = ITEM.replace("then Tom", "then Peter")  # one name, two values
    rows = [(0, ITEM), (1, noise(50) + " " + ITEM + " " + noise(60)), (2, noise(5) + " " + other + ". " + noise(9)), (3, noise(4) + " " + broken), (4, noise(300)), (5, None), (6, ""), (None, ITEM), (1, "twice " + ITEM), (7, (noise(20) + " " + ITEM + "\n") * 3), (8, " ".join(ITEM.split()[:11])), (9, noise(30000) + " " + other), (10, "Tom has 12 apples"), (11, ITEM.upper())]
    bench = [(0, ITEM), (1, noise(40)), (2, "short one"), (3, None), (4, ""), (5, ITEM), (None, noise(30))]
    got = check(spark, rows, bench)
    assert all(got[d][1] for d in (0, 1, 2, 7, 9)) and not any(got[d][1] for d in (3, 4, 5, 6, 8, 10))
    assert got[0][4] == [0, 5]
    monkeypatch.setattr(D, "BROADCAST", 0)  # the same by a shuffled join
    check(spark, rows, bench)


def test_random_texts(spark):
    rng = np.random.default_rng(8)
    words = ["the", "a", "of", "Ann", "Bob", "12", "7", "km", "cat", "dog", "sees", "and", "runs", "5", "g"]
    bench = [(i, " ".join(rng.choice(words, rng.integers(6, 40)))) for i in range(40)]
    rows = []
    for i in range(80):
        t = bench[int(rng.integers(0, 40))][1].split()
        for _ in range(rng.integers(0, 4)):
            t[int(rng.integers(0, len(t)))] = str(rng.choice(words))
        rows.append((i, " ".join(rng.choice(words, 10)) + " " + " ".join(t)))
    check(spark, rows, bench)


def test_empty_tables(spark):
    df, b = spark.createDataFrame([], DOCS), spark.createDataFrame([], BENCH)
    assert D.contaminated(df, b).collect() == []
    one = spark.createDataFrame([(1, ITEM, 1, "x", "y")], DOCS)
    assert [r.contaminated for r in D.contaminated(one, b).collect()] == [False]


def test_whole_search_conflicts_and_shifts(spark):
    """One of two equal names changed, a name of two words for one, an inserted word."""
    noise = "lorem ipsum dolor sit amet " * 3
    other = ITEM.replace("Tom", "Mary Ann").replace("12", "450").replace("30", "8.5")
    rows = [(0, ITEM.replace("then Tom", "then Peter")), (1, noise + other), (2, ITEM.replace("more apples", "more big apples").replace("7 apples", "7 small apples")), (3, noise), (4, " ".join(ITEM.split()[:11])), (5, ITEM.replace("30", "12"))]
    df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], DOCS)
    b = spark.createDataFrame([(7, ITEM, "z"), (8, ITEM, "z"), (9, None, "z")], BENCH)
    got = {r.id: r for r in D.contaminated(df, b, whole=True).collect()}
    assert [got[d].contaminated for d in range(6)] == [True, True, True, False, False, True]
    assert got[0]["items"] == [7, 8] and got[0].covered == len(tokens(ITEM)) - 1
    assert D.drop_contaminated(df, b, whole=True).count() == 2


def test_whole_search_word_for_word(spark):
    """Copies in other case, short items and items of names and numbers alone."""
    dense = "Anna Berta 12 Carla 13 Dora 14 Emil 15 Fritz 16 Gerda 17 Hans 18"
    rows = [(0, ITEM.upper()), (1, ITEM.lower()), (2, "Well: WHO wrote Faust? Someone"), (3, "who wrote it: Faust"), (4, "so " + dense.lower()), (5, "x " + " ".join(ITEM.lower().split()[5:18])), (6, "x " + " ".join(ITEM.lower().split()[5:17])), (7, "Straße eins"), (8, None)]
    df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], DOCS)
    b = spark.createDataFrame([(1, ITEM, "z"), (2, "Who wrote Faust?", "z"), (3, dense, "z"), (4, "", "z"), (5, "STRASSE EINS", "z")], BENCH)
    got = {r.id: (list(r["items"]), r.covered) for r in D.contaminated(df, b, whole=True).collect()}
    n = len(tokens(ITEM))
    assert got == {0: ([1], n), 1: ([1], n), 2: ([2], 3), 3: ([], 0), 4: ([3], len(tokens(dense))), 5: ([1], 13), 6: ([], 0), 7: ([5], 2), 8: ([], 0)}


def test_first_search_misses_nothing(spark, monkeypatch):
    """The whole search gives the same with every text let through, on texts cut from and glued to the items."""
    rng = np.random.default_rng(11)
    words = ["the", "a", "of", "Ann", "Bob", "Carl", "12", "7", "km", "cat", "dog", "sees", "and", "runs", "5", "g", "slowly", "home"]
    bench = [(i, " ".join(rng.choice(words, rng.integers(2, 40)))) for i in range(60)]
    rows = []
    for i in range(300):
        t = bench[int(rng.integers(0, 60))][1].split()
        s = int(rng.integers(0, max(1, len(t) - 8)))
        t = t[s : s + int(rng.integers(6, 20))]
        for _ in range(rng.integers(0, 2)):
            t[int(rng.integers(0, len(t)))] = str(rng.choice(["Zoe Max", "99", "the", "Ann"]))
        junk = [" ".join(f"x{'abcdef'[k]}y" for k in rng.integers(0, 6, rng.integers(0, 9))) for _ in range(2)]
        rows.append((i, f"{junk[0]} {' '.join(t)} {junk[1]}"))
    df, b = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], DOCS), spark.createDataFrame([(i, t, "z") for i, t in bench], BENCH)
    got = sorted(tuple(map(str, r)) for r in D.contaminated(df, b, whole=True).collect())
    monkeypatch.setattr(D, "possible", lambda texts, items, lengths: texts.select("__key").distinct())
    want = sorted(tuple(map(str, r)) for r in D.contaminated(df, b, whole=True).collect())
    assert got == want and 30 < sum(r[1] == "True" for r in got) < 300


def test_columns_that_clash_and_one_word_items(spark):
    names = "doc_id long, text string, __key string, __gone string, `a.b` string, __salt string, t0 string, H string"
    rows = [(0, ITEM, "k", "g", "d", "s", "t", "h"), (1, "yes indeed it is", "k", "g", "d", "s", "t", "h"), (2, None, "k", "g", "d", "s", "t", "h")]
    df, b = spark.createDataFrame(rows, names), spark.createDataFrame([(1, ITEM, "z"), (2, "Yes", "z")], BENCH)
    for whole in (False, True):
        kept = D.drop_contaminated(df, b, whole=whole)
        assert kept.columns == df.columns and sorted(map(tuple, kept.collect())) == rows[1:]
        assert {r.id: r.contaminated for r in D.contaminated(df, b, whole=whole).collect()} == {0: True, 1: False, 2: False}
