"""Small literal cases (FIXTURES.md part 3) on hand-built frames."""

import math

from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.geometry import angle_ok
from notchline.functions.text import java_split, render_point
from notchline.operators.band_join import band_join
from notchline.operators.gates import eligibility_flag, first_reason, flat_position
from notchline.operators.history import asof_counts, asof_join
from notchline.operators.lookup import first_by, prefix_join, substring_join
from notchline.operators.matching import attribute, band_match, latest_per_tool
from notchline.operators.patterns import summary_entries
from notchline.operators.sinks import batch_counts, keep_last, last_put
from notchline.sources.lookups import parse_arm_lines, side_eligible, with_sentinels


def test_substring_tools_are_not_confused(spark):
    det = spark.createDataFrame([(1, 5000.0, 0.0)], "unit long, r double, theta double")
    arms = spark.createDataFrame([("A1", 5.0, None, None), ("A10", 5.0, None, None)], "tool string, d1 double, d2 double, rot double")
    hist = spark.createDataFrame([(1, "A10", "20200101"), (1, "A1", "20300101")], "unit long, tool string, ts string")
    runs = spark.createDataFrame([(1, "20291231")], "unit long, run_ts string")
    held = latest_per_tool(hist, runs, "unit", "tool", "ts")
    got = attribute(det, arms, held, ["unit"], "tool").select("tool").collect()
    assert [r.tool for r in got] == ["A10"]


def test_history_first_attribution_equals_the_band_join(spark):
    """The pair test on history pairs gives what the band join followed by the history join gives."""
    from notchline.plans import model
    from notchline.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    arms = model.arms(t).select("s_suppkey", "tool", "area", "d1", "d2", "rot")
    held = model.history(t).groupBy(F.col("o_custkey").alias("c_custkey"), F.col("l_suppkey").alias("s_suppkey")).agg(F.max("l_shipdate").alias("last_ts"))
    new = attribute(model.detections(t), arms, held, ["c_custkey"], "s_suppkey", 500.0)
    old = band_match(model.detections(t), arms, 500.0).join(held, ["c_custkey", "s_suppkey"])
    cols = ["c_custkey", "s_suppkey", "last_ts"]
    assert new.count() == old.count() > 50
    assert new.select(cols).exceptAll(old.select(cols)).count() == 0


def test_prefix_join_by_separator_takes_ids_of_any_length(spark):
    ids = spark.createDataFrame([("Customer#000000001",), ("Customer#1000000000",)], "image string")
    index = spark.createDataFrame([("Customer#000000001_a", 1), ("Customer#1000000000_b", 2), ("Customer#100000000", 3)], "k string, v int")
    got = {(r.image, r.v) for r in prefix_join(ids, index, "image", "k", "_").collect()}
    assert got == {("Customer#000000001", 1), ("Customer#1000000000", 2)}


def test_asof_join_by_several_keys_keeps_runs_without_key_or_time(spark):
    hist = spark.createDataFrame([("u", 1, "20200101"), ("u", 1, "2020010112"), ("u", 2, "20200101"), (None, 1, "20200101"), ("u", 1, None)], "k string, n int, ts string")
    runs = spark.createDataFrame([("u", 1, "2020010112", 0), ("u", 1, "20200100", 1), (None, 1, "20300101", 2), ("u", 1, None, 3), ("u", 2, "20300101", 4), ("u", 1, "20300101", 5)], "k string, n int, ts string, i int")
    got = {r.i: (r.n_asof, r.last_ts) for r in asof_join(runs, hist, ["k", "n"], "ts", "ts").collect()}
    assert got == {0: (2, "2020010112"), 1: (0, None), 2: (0, None), 3: (0, None), 4: (1, "20200101"), 5: (2, "2020010112")}


def test_short_arm_row_dropped(spark):
    lines = spark.createDataFrame([("a,b,c",), ("0,AREA,x,y,TOOL",)], "value string")
    rows = parse_arm_lines(lines).collect()
    assert [(r.area, r.tool) for r in rows] == [("AREA", "TOOL")]


def test_side_rule(spark):
    df = spark.createDataFrame([("BACK",), ("FRONT",), (None,)], "side string")
    front = [r[0] for r in df.select(side_eligible(F.col("side"), C.SIDE_FRONT)).collect()]
    back = [r[0] for r in df.select(side_eligible(F.col("side"), C.SIDE_BACK)).collect()]
    assert front == [False, True, True]
    assert back == [True, False, True]


def test_bad_numbers_fall_back(spark):
    line = "0,AREA,x,y,TOOL,,,,x,,,,NO"
    rows = parse_arm_lines(spark.createDataFrame([(line,)], "value string")).collect()
    assert rows[0].d1 is None and rows[0].d2 is None and rows[0].rot is None
    r = with_sentinels(parse_arm_lines(spark.createDataFrame([(line,)], "value string"))).first()
    assert (r.d1, r.d2, r.rot) == (C.MISSING_DIMENSION, C.MISSING_DIMENSION, C.NO_ROTATION)


def test_rotation_text(spark):
    base = "0,AREA,x,y,TOOL,,,,1,2,,,"
    lines = [(base + "YES 90deg,FRONT",), (base + "NO,FRONT",), (base + "YES,FRONT",)]
    rows = parse_arm_lines(spark.createDataFrame(lines, "value string")).collect()
    assert [r.rot for r in rows] == [90.0, None, None]
    assert [r.side for r in rows] == ["FRONT"] * 3


def test_java_split_drops_trailing_empties(spark):
    df = spark.createDataFrame([("a,,b,,",)], "s string")
    assert df.select(java_split(F.col("s"), ",")).first()[0] == ["a", "", "b"]


def test_device_match_on_first_line_of_odd_file(spark):
    lines = spark.createDataFrame(
        [(0, "0,DEV7,x,x,90"), (1, "1,OTHER,x,x,180"), (2, "2,MORE,x,x,270")],
        "line_key int, line string",
    ).withColumn("flat", F.get(F.split("line", ","), 4).cast("int"))
    devices = spark.createDataFrame([("DEV7",), ("ZZ",)], "device string")
    hits = substring_join(devices, lines, "device", "line")
    first = first_by(hits, ["device"], ["line_key"], ["flat"]).collect()
    assert [(r.device, r.flat) for r in first] == [("DEV7", 90)]


def test_substring_join_short_needles(spark):
    hay = spark.createDataFrame([(1, "abc"), (2, "xbz")], "id int, h string")
    needles = spark.createDataFrame([("b",), ("bc",), ("abc",), ("",)], "n string")
    got = sorted((r.n, r.id) for r in substring_join(needles, hay, "n", "h").collect())
    assert got == [("abc", 1), ("b", 1), ("b", 2), ("bc", 1)]


def test_device_none_gets_flat_zero(spark):
    df = spark.createDataFrame([("None", None), ("BARE", None), ("D1", None), ("D2", 90)], "d string, f int")
    got = [r[0] for r in df.select(flat_position(F.col("d"), F.col("f"))).collect()]
    assert got == [0, 0, None, 90]


def test_missing_history_row_dropped_run_kept(spark):
    ids = spark.createDataFrame([("IMG000000001",)], "image string")
    index = spark.createDataFrame(
        [("IMG000000001_a", "20200101_1"), ("IMG000000001_b", "20200102_2")], "k string, value string"
    )
    rows = spark.createDataFrame([("20200101_1", "run,T1,WS")], "rowkey string, rundata string")
    idx = prefix_join(ids, index, "image", "k", 12)
    fetched = idx.join(rows, idx["value"] == rows["rowkey"])
    assert fetched.count() == 1
    assert prefix_join(ids, index, "image", "k", 12, how="left").select("image").distinct().count() == 1


def test_asof_tie_is_kept(spark):
    hist = spark.createDataFrame([("u", "20200101"), ("u", "20200102"), ("u", "20200103")], "k string, ts string")
    runs = spark.createDataFrame([("u", "20200102")], "k string, ts string")
    r = asof_join(runs, hist, "k", "ts", "ts").first()
    assert r.n_asof == 2 and r.last_ts == "20200102"
    c = {x.ts: x.n_asof for x in asof_counts(hist, "k", "ts").collect()}
    assert c == {"20200101": 1, "20200102": 2, "20200103": 3}


def test_band_edge_matches(spark):
    left = spark.createDataFrame([(1, 1.5)], "a int, v double")
    right = spark.createDataFrame([(2, 2.0), (3, 2.0000001)], "b int, w double")
    got = [r.b for r in band_join(left, right, "v", "w", 0.5).collect()]
    assert got == [2]


def _match(spark, d1, d2, rot, r, theta):
    det = spark.createDataFrame([(1, float(r), float(theta))], "det int, r double, theta double")
    arm = spark.createDataFrame([(9, d1, d2, rot)], "arm int, d1 double, d2 double, rot double")
    return band_match(det, arm, 0.5).count() == 1


def test_d1_match_needs_no_angle(spark):
    assert _match(spark, 10.0, 99.0, 45.0, 10000.0, 3.0)


def test_d2_match_needs_angle(spark):
    assert not _match(spark, 99.0, 10.0, 45.0, 10000.0, 3.0)
    assert _match(spark, 99.0, 10.0, 45.0, 10000.0, math.pi / 4)
    assert _match(spark, 99.0, 10.0, None, 10000.0, 3.0)  # no rotation: any angle


def test_angle_wrap_and_opposite(spark):
    df = spark.createDataFrame([(359.0, 0.01), (270.0, math.pi / 2)], "rot double, theta double")
    got = [r[0] for r in df.select(angle_ok(F.col("rot"), F.col("theta"))).collect()]
    assert got == [False, True]


def test_keep_last(spark):
    df = spark.createDataFrame([(1, 7, 1, "old"), (1, 7, 2, "new")], "run int, id int, seq int, v string")
    rows = keep_last(df, ["run", "id"], ["seq"], ["v"]).collect()
    assert [r.v for r in rows] == ["new"]


def test_render_extra_fields(spark):
    df = spark.createDataFrame([("1 2 3 4",), (" 5  6 ",)], "p string")
    got = [r[0] for r in df.select(render_point(F.col("p"), ["A", "B", "C"])).collect()]
    assert got == ["A:1,B:2,C:3 4", "A:5,B:6"]


def test_flag_override(spark):
    df = spark.createDataFrame([("XKSPX", 1), ("XKSPX", 0), ("RMAC", 3), ("KT28", 2)], "st string, j int")
    got = [r[0] for r in df.select(eligibility_flag(F.col("st"), F.col("j"))).collect()]
    assert got == [False, True, True, False]


def test_first_reason_order(spark):
    df = spark.createDataFrame([(5,), (50,), (500,)], "v int")
    r = first_reason([("small", F.col("v") < 10), ("mid", F.col("v") < 100), ("nullcheck", F.lit(None))])
    assert [x[0] for x in df.select(r).collect()] == ["small", "mid", None]


def test_empty_back_side_count_zero(spark):
    runs = spark.createDataFrame([(1,), (2,)], "run long")
    lines = spark.createDataFrame([(1, 1, 3, 4)], "run long, line_no int, theta_bin int, r_bin long")
    rows = {(r.run, r.qualifier): r.value for r in summary_entries(runs, lines, "run", C.SIDE_BACK).collect()}
    assert rows == {(1, "BNO_yES"): "1", (2, "BNO_yES"): "0", (1, "By1"): "THETA:3,R:4"}


def test_status_last_put_wins(spark):
    df = spark.createDataFrame([(0,), (2,)], "n int")
    puts = F.array(
        F.struct(F.lit(1).alias("seq"), F.when(F.col("n") > 0, F.lit("1")).alias("value")),
        F.struct(F.lit(2).alias("seq"), F.lit("0").alias("value")),
    )
    assert [r[0] for r in df.select(last_put(puts)).collect()] == ["0", "0"]


def test_batch_counts(spark):
    df = spark.createDataFrame([("a", 250), ("b", 100), ("c", 1)], "k string, n long")
    got = sorted((r.k, r.batch, r.n_rows) for r in batch_counts(df, "k", "n", 100).collect())
    assert got == [("a", 0, 100), ("a", 1, 100), ("a", 2, 50), ("b", 0, 100), ("c", 0, 1)]


def test_require_tables(spark):
    import pytest

    from notchline.sources.tables import require_tables

    spark.range(3).createOrReplaceTempView("hist_index_present")
    require_tables(spark, ["hist_index_present"])
    with pytest.raises(LookupError):
        require_tables(spark, ["hist_index_present", "no_such_history_table"])


def test_read_properties(spark, tmp_path):
    from notchline.sources.lookups import read_properties

    for i, body in enumerate(["# c\nradius = 1.5\nangle=0.3\n", "radius=2\n\n!x\nk=a=b\n"]):
        (tmp_path / f"ParamConfig{i}.properties").write_text(body)
    rows = read_properties(spark, str(tmp_path)).collect()
    got = sorted((r.profile, r.key, r.value) for r in rows)
    assert got == [(0, "angle", "0.3"), (0, "radius", "1.5"), (1, "k", "a=b"), (1, "radius", "2")]


def test_reference_gate_chain(spark):
    from notchline.operators.gates import reference_checks

    good = {"DeviceID": "D1", "imageID": "ABCDEFGHIJKL"}
    cases = [
        ("1.8", {**good, "domainType": "CIRCL"}, 1, 90, "excluded_type"),
        ("1.8", {**good, "DiePitchX": "300000000"}, 1, 90, "excluded_type"),
        ("1.7", {**good, "domainarge": "domainarge"}, 1, 90, "placeholder"),
        ("1.8", {**good, "domainarge": "domainarge"}, 1, 90, None),
        ("1.7", {"imageID": "ABCDEFGHIJKL"}, 1, 90, "missing_device"),
        ("1.7", {"DeviceID": "D1", "imageID": "SHORT"}, 1, 90, "bad_id_length"),
        ("1.7", {"DeviceID": "D1"}, 1, 90, "bad_id_length"),
        ("1.7", good, 99, 90, "too_many_points"),
        ("1.7", good, 1, None, "no_flat_position"),
        ("1.7", {**good, "DeviceID": "None"}, 1, None, None),
        ("1.7", good, 1, 90, None),
    ]
    df = spark.createDataFrame(
        [(v, h, n, f) for v, h, n, f, _ in cases], "version string, header map<string,string>, n int, flat int"
    )
    checks = reference_checks(F.col("header"), F.col("version"), F.col("n"), F.col("flat"), maxpoint=10)
    got = [r[0] for r in df.select(first_reason(checks)).collect()]
    assert got == [c[-1] for c in cases]


def test_batch_counts_chunked(spark):
    df = spark.createDataFrame([("hot", 2_345), ("cold", 7)], "k string, n long")
    rows = batch_counts(df, "k", "n", 10, chunk=4).collect()
    hot = sorted((r.batch, r.n_rows) for r in rows if r.k == "hot")
    assert [b for b, _ in hot] == list(range(235))
    assert sum(n for _, n in hot) == 2_345 and hot[-1] == (234, 5)
    assert [(r.batch, r.n_rows) for r in rows if r.k == "cold"] == [(0, 7)]


def test_asof_levels_equal_brute_force(spark):
    import datetime as dt
    import random

    from notchline.operators.history import by_day, by_second

    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    hist = [(rnd.choice("ab"), base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400, 997))) for _ in range(60)]
    hist += [("a", hist[0][1])] * 3  # ties
    runs = [(rnd.choice("abc"), base + dt.timedelta(seconds=rnd.randrange(0, 4 * 86400, 1009))) for _ in range(25)]
    hdf = spark.createDataFrame(hist, "k string, ts timestamp_ntz")
    rdf = spark.createDataFrame(runs, "k string, rt timestamp_ntz")
    for levels in [None, (), (by_day, by_second)]:
        got = {(r.k, r.rt): (r.n_asof, r.last_ts) for r in asof_join(rdf, hdf, "k", "rt", "ts", levels).collect()}
        for k, t in runs:
            before = [h for kk, h in hist if kk == k and h <= t]
            want = (len(before) if before else (0 if any(kk == k for kk, _ in hist) else None),
                    max(before) if before else None)
            n, last = got[(k, t)]
            assert (n or 0, last) == (want[0] or 0, want[1]), (k, t)
        c = {(r.k, r.ts): (r.n_asof, r.prev_ts) for r in asof_counts(hdf, "k", "ts", levels).collect()}
        for k, t in set(hist):
            n = sum(1 for kk, h in hist if kk == k and h <= t)
            earlier = [h for kk, h in hist if kk == k and h < t]
            assert c[(k, t)] == (n, max(earlier) if earlier else None)


def test_envelope_round_trip_with_source(spark, tmp_path):
    from notchline.sources.envelope import read_envelope, write_envelope

    files = spark.createDataFrame([("a.txt", "x é"), ("b.txt", None)], "filename string, file_contents string")
    write_envelope(files, str(tmp_path / "env"))
    got = read_envelope(spark, str(tmp_path / "env"), with_source=True).collect()
    assert sorted((r.filename, r.file_contents) for r in got) == [("a.txt", "x é"), ("b.txt", None)]
    assert all(r.source_file.endswith(".parquet") for r in got)


def test_all_lines_of_a_large_run_are_kept_on_both_sides(spark):
    from notchline.operators.patterns import detect_lines, summarize_runs

    # 3 points at each of 40 places of one row of the field, and a run without lines
    pts = [(1, float(x), 0.0, x % 2 == 0) for x in range(40) for _ in range(3)] + [(2, 1.0, 1.0, False)]
    p = spark.createDataFrame(pts, "run long, x double, y double, back boolean")
    lines = detect_lines(p, "run", "x", "y").collect()
    assert {r.run for r in lines} == {1} and len(lines) > 18 and min(r.votes for r in lines) >= 3
    assert sorted(r.line_no for r in lines) == list(range(1, len(lines) + 1))
    side = F.when(F.col("back"), F.lit("B")).otherwise(F.lit(""))
    rows = {(r.run, r.qualifier): r.value for r in summarize_runs(p, "run", "x", "y", side, ("", "B")).collect()}
    for s, back in (("", False), ("B", True)):
        n = detect_lines(p.where(F.col("back") == back), "run", "x", "y").where("run = 1").count()
        assert rows[1, s + "NO_yES"] == str(n) and rows[2, s + "NO_yES"] == "0"
        assert {q for r, q in rows if r == 1 and q.startswith(s + "y")} == {f"{s}y{k}" for k in range(1, n + 1)}


def test_header_map(spark):
    from notchline.functions.text import with_header

    text = ('Record FileRecord\nField InspectionStationID 3 {"KLA-TENCOR", "Puma9850M", "KTPUAX0800"}\n'
            'Field DeviceID 1 {"D42"}\nField Empty 0 {}\nField DeviceID 1 {"D43"}\n')
    many = "\n".join(f'Field F{i % 900} 1 {{"{i}"}}' for i in range(3000))
    df = spark.createDataFrame([(1, text), (2, many), (3, None), (4, "")], "i int, t string")
    m = {r.i: r.m for r in with_header(df, "t", "m").collect()}
    assert m[1] == {"InspectionStationID": "KTPUAX0800", "domainType": "Puma9850M", "DeviceID": "D43"}
    assert m[2] == {f"F{k}": str(max(range(k, 3000, 900))) for k in range(900)}
    assert m[3] is None and m[4] == {}
    m2 = with_header(df, "t", "m", 2).where("i = 1").first().m
    assert m2["InspectionStationID"] == "Puma9850M" and m2["DeviceID"] is None


def test_text_gates_give_every_reason(spark):
    from notchline.plans.gate_queries import gates_from_text

    got = {r.reason for r in gates_from_text(spark, "/root/testdata/sf0.01").select("reason").distinct().collect()}
    assert got >= {None, "excluded_type", "placeholder", "missing_device", "bad_id_length", "no_flat_position"}


def test_lookup_first_line(spark):
    from notchline.operators.lookup import lookup_first_line

    lines = spark.createDataFrame(
        [(0, 0, "0,NATION_10,x,x,180"), (1, 1, "1,NATION_1,x,x,90"), (2, 1, "2,OTHER,x,x,270")],
        "line_key int, grp int, line string",
    ).withColumn("flat", F.get(F.split("line", ","), 4).cast("int"))
    runs = spark.createDataFrame([(7, "NATION_1"), (8, "NATION_1"), (9, "MISSING"), (10, None)], "run int, dev string")
    got = {r.run: r.flat for r in lookup_first_line(runs, "dev", lines, "line", ["grp", "line_key"], ["flat"]).collect()}
    assert got == {7: 180, 8: 180, 9: None, 10: None}


def test_write_partitioned_batches_and_devices(spark, tmp_path):
    import pyarrow.parquet as pq

    from notchline.operators.sinks import write_partitioned

    df = spark.range(0, 2500).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'D1' ELSE 'D2' END AS device")
    path = str(tmp_path / "sink")
    write_partitioned(df.repartition(1), path, "device", batch=300)
    files = sorted((tmp_path / "sink").rglob("*.parquet"))
    assert {f.parent.name for f in files} == {"device=D1", "device=D2"}
    assert all(pq.ParquetFile(f).metadata.num_rows <= 300 for f in files)
    assert spark.read.parquet(path).count() == 2500
    write_partitioned(df, path, "device", mode="overwrite")
    assert spark.read.parquet(path).count() == 2500
