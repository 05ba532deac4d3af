"""Property tests: the rewritten joins equal their brute-force definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from notchline.operators.band_join import band_join, multi_band_join
from notchline.operators.lookup import substring_join
from notchline.operators.sinks import keep_last

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

vals = st.lists(st.integers(-400, 400).map(lambda v: v / 8.0), min_size=0, max_size=25)
tols = st.sampled_from([0.125, 0.5, 1.0, 3.0, 17.5])


@settings(**SETTINGS)
@given(a=vals, b=vals, tol=tols, strict=st.booleans())
def test_band_join_equals_nested_loop(spark, a, b, tol, strict):
    left = spark.createDataFrame(list(enumerate(a)), "i int, v double")
    right = spark.createDataFrame(list(enumerate(b)), "j int, w double")
    got = sorted((r.i, r.j) for r in band_join(left, right, "v", "w", tol, strict=strict).collect())
    want = sorted(
        (i, j)
        for i, x in enumerate(a)
        for j, y in enumerate(b)
        if (abs(x - y) < tol if strict else abs(x - y) <= tol)
    )
    assert got == want


@settings(**SETTINGS)
@given(
    a=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40).map(float), st.integers(0, 20).map(float)), max_size=20),
    b=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40).map(float), st.integers(0, 20).map(float)), max_size=20),
)
def test_multi_band_join_equals_nested_loop(spark, a, b):
    left = spark.createDataFrame([(i, *t) for i, t in enumerate(a)], "i int, k int, t double, v double")
    right = spark.createDataFrame([(j, *t) for j, t in enumerate(b)], "j int, k2 int, t2 double, v2 double")
    out = multi_band_join(left, right, [("t", "t2", 3.0), ("v", "v2", 2.0)], keys=[("k", "k2")])
    got = sorted((r.i, r.j) for r in out.collect())
    want = sorted(
        (i, j)
        for i, (k, t, v) in enumerate(a)
        for j, (k2, t2, v2) in enumerate(b)
        if k == k2 and abs(t - t2) <= 3.0 and abs(v - v2) <= 2.0
    )
    assert got == want
    # one-sided time band: only earlier partners, right side repeated into 2 cells
    out1 = multi_band_join(
        left, right, [("t", "t2", 3.0, "left_ge"), ("v", "v2", 2.0)], keys=[("k", "k2")],
        residual=left["t"] >= right["t2"],
    )
    got1 = sorted((r.i, r.j) for r in out1.collect())
    assert got1 == sorted((i, j) for i, j in want if a[i][1] >= b[j][1])


words = st.text(alphabet="abAB_1", min_size=0, max_size=7)


@settings(**SETTINGS)
@given(needles=st.lists(words, max_size=8), hay=st.lists(words, max_size=8))
def test_substring_join_equals_brute_force(spark, needles, hay):
    n = spark.createDataFrame([(i, s) for i, s in enumerate(needles)], "ni int, needle string")
    h = spark.createDataFrame([(j, s) for j, s in enumerate(hay)], "hj int, line string")
    got = sorted((r.ni, r.hj) for r in substring_join(n, h, "needle", "line").collect())
    want = sorted(
        (i, j) for i, x in enumerate(needles) for j, y in enumerate(hay) if len(x) > 0 and x in y
    )
    assert got == want


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 9)), max_size=20))
def test_keep_last_is_idempotent_and_maximal(spark, rows):
    df = spark.createDataFrame(rows, "k int, seq int, v int")
    once = keep_last(df, ["k"], ["seq", "v"], [])
    twice = keep_last(once, ["k"], ["seq", "v"], [])
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    want = {}
    for k, s, v in rows:
        want[k] = max(want.get(k, (s, v)), (s, v))
    assert a == sorted((k, s, v) for k, (s, v) in want.items())


@settings(**SETTINGS)
@given(
    rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.integers(-5, 5))),
                  min_size=1, max_size=15),
    cuts=st.lists(st.integers(-5, 5), min_size=1, max_size=4),
)
def test_gates_give_the_first_firing_reason(spark, rows, cuts):
    from pyspark.sql import functions as F

    from notchline.operators.gates import first_reason

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a int, b int")
    # alternate predicates on a and b; null inputs make a predicate null (not firing)
    checks = [
        (f"g{j}", (F.col("a") > c) if j % 2 == 0 else (F.col("b") < c)) for j, c in enumerate(cuts)
    ]
    got = {r.i: r.reason for r in df.select("i", first_reason(checks).alias("reason")).collect()}
    for i, (a, b) in enumerate(rows):
        want = None
        for j, c in enumerate(cuts):
            v = a if j % 2 == 0 else b
            if v is not None and ((v > c) if j % 2 == 0 else (v < c)):
                want = f"g{j}"
                break
        assert got[i] == want
