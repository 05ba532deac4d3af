"""File texts to rows: header fields, listed points, line caps; damaged files."""

import random

from pyspark.sql import functions as F

from notchline import constants as C
from notchline.operators.blocks import KIND_POINT, block_lines, parse_files, run_facts
from notchline.sources import folders
from notchline.sources.envelope import read_with_rejects, write_envelope

TEXT = "\n".join([
    "Record FileRecord",
    'Field DeviceID 1 {"D1"}',
    "List Other 2 { A B }",
    "9 9",
    "EndOfList",
    'Field InspectionStationID 3 {"MAKER", "Type9", "ST1"}',
    "List PointList 4 { ID FLAG X Y }",
    "1 RO 0.017 0.005",
    "  2   AF  0.5 bad  ",
    "",
    "1 NF 0.001 -0.002 more fields",
    "EndOfList",
    'Field DeviceID 1 {"D2"}',
    "List PointList 3 { X ID Y }",
    "2 7 3",
])


def test_points_and_header_of_a_text(spark):
    df = spark.createDataFrame([(1, TEXT, "x"), (2, TEXT.replace("Record FileRecord", "Version").replace("\n", "\r\n"), "x"), (3, None, "x"), (4, "", "x")], "k int, t string, block string")
    rows = parse_files(df, "k", "t").collect()
    files = {r.k: r for r in rows if r.kind == "file"}
    assert {k: r.header for k, r in files.items()} == {k: {"DeviceID": "D2", "InspectionStationID": "ST1", "domainType": "Type9"} if k < 3 else {} for k in (1, 2, 3, 4)}
    assert {k: r.version for k, r in files.items()} == {1: "1.8", 2: "1.7", 3: "1.7", 4: "1.7"}
    points = [(r.name, r.value, r.x, r.y, r.flag) for r in sorted((r for r in rows if r.kind == "point" and r.k == 1), key=lambda r: (r.block, r.pos))]
    assert points == [
        ("point1", "ID:1,FLAG:RO,X:0.017,Y:0.005", 17.0, 5.0, "RO"),
        ("point2", "ID:2,FLAG:AF,X:0.5,Y:bad", 500.0, None, "AF"),
        ("point1", "ID:1,FLAG:NF,X:0.001,Y:-0.002 more fields", 1.0, None, "NF"),
        ("point2", "X:2,ID:7,Y:3", 2000.0, 3000.0, None),
    ]
    old = [(r.x, r.y) for r in sorted((r for r in rows if r.kind == "point" and r.k == 2), key=lambda r: (r.block, r.pos))]
    assert old == [(0.017, 0.005), (0.5, None), (0.001, None), (2.0, 3.0)]
    facts = {r.k: (r.n_all, r.n_back, r.j_all, r.j_front) for r in run_facts(parse_files(df, "k", "t"), "k", F.when(F.col("flag").startswith("N"), 0).otherwise(1), F.coalesce(F.col("flag").endswith("O"), F.lit(False))).collect()}
    assert facts[1] == (4, 1, 3, 2) and facts[3] == facts[4] == (0, 0, 0, 0)


def test_line_cap_differs_by_dialect(spark):
    body = "List PointList 1 { ID }\n" + "\n".join(str(i) for i in range(100))
    df = spark.createDataFrame([(1, "Record FileRecord\n" + body), (2, "old\n" + body)], "k int, t string")
    n = {r.k: r["count"] for r in parse_files(df, "k", "t").where(F.col("kind") == KIND_POINT).groupBy("k").count().collect()}
    assert n == {1: C.LINE_CAP_NEW - 2, 2: C.LINE_CAP_OLD - 2}


def test_blocks_equal_a_line_by_line_walk(spark):
    rng = random.Random(4)
    kinds = ["Field A 1 {\"1\"}", "List L1 2 { A B }", "List  L2 1 { C }", "EndOfList", "1 2", "", "Listless", " List X 1 { A }"]
    texts = ["\n".join(rng.choice(kinds) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    want = []
    for k, text in enumerate(texts):
        open_list, names, closed, block, first = None, None, False, 0, 0
        for i, line in enumerate(text.split("\n")):
            if line.startswith("List ") and line != "Listless":
                block += i > 0
                first = i
                open_list, names, closed = line.split()[1], line[line.index("{") + 1 : line.index("}")].split(), False
                continue
            if line == "EndOfList" and open_list and not closed:
                closed = True
                continue
            inside = open_list is not None and not closed
            want.append((k, block, i - first, open_list if inside else None, tuple(names) if inside else None, line))
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = [(r.k, r.block, r.pos, r.list, tuple(r.names) if r.names else None, r.line) for r in block_lines(df, "t").collect()]
    assert sorted(got, key=lambda r: r[:3]) == want


def test_a_text_is_parsed_once_in_the_stored_plan(spark):
    from notchline.plans.gate_queries import gates_from_text, points_from_text

    for q in (gates_from_text, points_from_text):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all(__header" not in plan and "PointList" not in plan  # parsed before, read back here


def test_damaged_files_and_records_become_rows(spark, tmp_path):
    path = str(tmp_path / "in")
    files = spark.createDataFrame([("a", "text"), ("b", ""), (None, "x"), ("c", None)], "filename string, file_contents string")
    write_envelope(files.coalesce(1), path)
    folders.write_text(spark, f"{path}/broken.parquet", "PAR1....")
    good, bad = read_with_rejects(spark, path)
    assert sorted((r.filename, r.file_contents) for r in good.collect()) == [("a", "text"), ("b", "")]
    assert sorted((r.filename or "", r.reason) for r in bad.collect()) == [("", "no file name"), ("", "unreadable"), ("c", "no contents")]
    assert [r.source_file for r in bad.where("reason = 'unreadable'").collect()] == ["broken.parquet"]
    only = str(tmp_path / "only")
    folders.write_text(spark, f"{only}/broken.parquet", "x" * 50)
    good, bad = read_with_rejects(spark, only)
    assert good.count() == 0 and bad.count() == 1
