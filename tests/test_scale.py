"""Plans and placements that keep their figures on larger tables."""

from pyspark.sql import functions as F

from notchline.operators import groups, lookup
from notchline.operators.band_join import multi_band_join
from notchline.operators.patterns import density_levels, detect_lines, line_peaks, profile_lines, summarize_runs


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_the_repeated_side_of_a_band_join_is_not_broadcast(spark, capsys):
    key = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(key)
    try:
        spark.conf.set(key, "10m")
        left = spark.createDataFrame([(1, 1.0, 2.0)], "k long, t double, v double")
        right = spark.createDataFrame([(1, 2.0, 2.5), (1, 9.0, 2.5)], "k2 long, t2 double, v2 double")
        out = multi_band_join(left, right, [("t", "t2", 3.0), ("v", "v2", 2.0)], keys=[("k", "k2")])
        assert "Broadcast" not in _plan(out, capsys)
        assert [r.t2 for r in out.collect()] == [2.0]
    finally:
        spark.conf.set(key, saved)


def test_groups_are_placed_by_size_and_large_ones_shuffled(spark, monkeypatch):
    """One run too large for a task and many small ones: rows as without placement, a task for every limit's worth."""
    monkeypatch.setattr(groups, "TASK_ROWS", 90)  # 5 rows of 18 votes
    rows = [(r, float(k % 4), float(k % 3)) for r in range(40) for k in range(3 + r % 2)] + [(99, float(k % 7), float(k % 5)) for k in range(200)] + [(None, 1.0, 2.0)] * 3
    pts = spark.createDataFrame(rows, "run long, x double, y double").coalesce(1)
    sizes = []

    def work(p):
        sizes.append(p.rdd.getNumPartitions())
        return p.groupBy("run").agg(F.count(F.lit(1)).alias("n"))

    got = {r.run: r.n for r in groups.within_groups(pts, "run", work, 18).collect()}
    assert got == {None: 3, 99: 200} | {r: 3 + r % 2 for r in range(40)}
    assert sizes[0] == -(-len(rows) // 5) and len(sizes) == 2
    spread = detect_lines(pts, "run", "x", "y").collect()
    monkeypatch.setattr(groups, "TASK_ROWS", 1_000_000)
    assert sorted(map(str, spread)) == sorted(map(str, detect_lines(pts, "run", "x", "y").collect()))
    assert {r.run for r in spread} == {None, 99, *range(40)}


def test_votes_do_not_cross_a_shuffle(spark, capsys, monkeypatch):
    """Votes are many times the points: only points are dealt, into a stated number of tasks."""
    monkeypatch.setattr(groups, "TASK_ROWS", 2000)
    pts = spark.createDataFrame([(r, 1.0, 2.0) for r in range(300) for _ in range(4)], "run long, x double, y double")
    profiles = spark.createDataFrame([(0, 6, 4.0, 3), (1, 8, 5.0, 3)], "profile int, angles int, r_bin double, least_votes long")
    for df in (
        detect_lines(pts, "run", "x", "y"),
        summarize_runs(pts, "run", "x", "y"),
        line_peaks(pts, "run", "x", "y"),
        profile_lines(pts, profiles, "run", "x", "y"),
        density_levels(pts, "run", "x", "y", 1.0, 1.0, 3),
    ):
        plan = _plan(df, capsys)
        assert plan.count("Exchange hashpartitioning(run") == plan.count("REPARTITION_BY_NUM") == 1
        assert df.count() > 0


def test_substring_join_finds_needles_of_all_lengths_at_all_places(spark, monkeypatch):
    text = "ab\U0001f98acdefghijabcdefghijklmnaaaaaaaaaaaab"
    hay = [(i, "x" * i + text + "y" * (i % 3)) for i in range(9)] + [(9, "abcdefg"), (10, "x" * 9 + text), (11, None), (12, "")]
    needles = [(text[i : i + k],) for k in range(1, 13) for i in range(0, len(text) - k, 2)] + [("a" * 8,), ("a" * 8,), ("nowhere at all",), (None,), ("",)]
    h = spark.createDataFrame(hay, "id int, line string")
    want = sorted((n, i) for (n,) in needles for i, t in hay if n and t and n in t)
    for few in (200_000, 0):  # pieces broadcast, and not
        monkeypatch.setattr(lookup, "BROADCAST_NEEDLES", few)
        out = lookup.substring_join(spark.createDataFrame(needles, "needle string"), h, "needle", "line")
        assert out.columns == ["needle", "id", "line"]
        assert sorted((r.needle, r.id) for r in out.collect()) == want


def test_long_needles_read_the_lines_without_counting_grams(spark, capsys):
    h = spark.createDataFrame([(1, "some line of text")], "id int, line string")
    out = lookup.substring_join(spark.createDataFrame([("line of text",)], "needle string"), h, "needle", "line")
    assert "LeftSemi" not in _plan(out, capsys)
    assert out.count() == 1
