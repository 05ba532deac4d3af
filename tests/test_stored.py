"""Stored tables: puts across runs, expiry by directory, bucketed histories, running totals, groups."""

import datetime as dt
import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from notchline.operators.components import components
from notchline.operators.consolidate import near_groups
from notchline.operators.history import asof_counts, asof_join
from notchline.operators.prefix import MAX, SUM, running
from notchline.operators.sinks import expire_partitions, retained, upsert, write_partitioned
from notchline.sources import folders
from notchline.sources.history_store import KeyedTable


def test_upsert_replaces_cells_and_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int, seq int, dev string"
    first = spark.createDataFrame([("a", 1, 1, "D1"), ("b", 2, 1, "D1"), ("a", 3, 1, "D2"), ("n", 4, 1, None), ("z", None, 1, "D3")], schema)
    assert upsert(first, path, ["k"], "dev", ["seq"]) and spark.read.schema(schema).parquet(path).count() == 5
    # a partition that the second run does not touch is not read: it can even be damaged
    for f in glob.glob(f"{path}/dev=D2/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"damaged")
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/dev=D2/*")}
    second = spark.createDataFrame([("b", 20, 1, "D1"), ("b", 21, 2, "D1"), ("c", 30, 1, "D1"), ("n", None, 1, None), ("q", 5, 1, "D4")], schema)
    touched = upsert(second, path, ["k"], "dev", ["seq"])
    assert sorted(str(t["dev"]) for t in touched) == ["D1", "D4", "None"]
    got = spark.read.schema(schema).parquet(path).where("dev IS NULL OR dev <> 'D2'").collect()
    assert {(r.k, r.v, r.dev) for r in got} == {("a", 1, "D1"), ("b", 21, "D1"), ("c", 30, "D1"), ("q", 5, "D4"), ("z", None, "D3"), ("n", None, None)}
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{path}/dev=D2/*")} == before
    assert upsert(second.limit(0), path, ["k"], "dev", ["seq"]) == []


def test_upsert_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        upsert(spark.createDataFrame(rows, "k int, v string"), path, ["k"], None)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_expiry_drops_directories_and_reads_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.datetime(2020, m, d, 6) for m in range(1, 7) for d in (1, 15, 28)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, ts timestamp_ntz").withColumn("month", F.trunc("ts", "month"))
    write_partitioned(rows, path, "month")
    for f in glob.glob(f"{path}/month=2020-01-01/*.parquet"):  # expired: must not be read
        with open(f, "wb") as out:
            out.write(b"damaged")
    kept = retained(spark, path, rows.schema, "month", "ts", 50)
    assert sorted(r.i for r in kept.collect()) == [i for i, d in enumerate(days) if d >= days[-1] - dt.timedelta(days=50)]
    assert folders.partition_values(spark, path, "month") == ["2020-05-01", "2020-06-01"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert expire_partitions(spark, path, "month", "2020-06-01") == ["2020-05-01"]


def test_bucketed_history_is_not_shuffled(spark):
    rows = spark.range(5000).selectExpr("CAST(id % 700 AS STRING) AS k", "id AS v")
    store = KeyedTable.write(rows.unionByName(spark.createDataFrame([(None, 1)], "k string, v long")), F.col("k"), 8)
    asked = spark.createDataFrame([("3",), ("699",), ("nobody",), (None,)], "asked string")
    joined = store.of(asked, "asked", "left")
    assert sorted((r.asked or "", r.n) for r in joined.groupBy("asked").agg(F.count("v").alias("n")).collect()) == [("", 0), ("3", 8), ("699", 7), ("nobody", 0)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = plan.index(f"FileScan parquet spark_catalog.default.{store.name}")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange hashpartitioning") < scan and "Bucketed: true" in plan
    # a few keys read their buckets only: all other files may be damaged
    few = store.get(["3", "5"])
    mine = {r[0].rsplit("/", 1)[1] for r in few.select(F.input_file_name()).distinct().collect()}
    files = glob.glob(spark.sql(f"DESCRIBE FORMATTED {store.name}").where("col_name = 'Location'").first().data_type.replace("file:", "") + "/*.parquet")
    others = [f for f in files if os.path.basename(f) not in mine]
    assert len(others) >= 6
    for f in others:
        with open(f, "wb") as out:
            out.write(b"damaged")
    assert few.count() == 16


def test_half_the_rows_on_one_key_day(spark):
    """No window is larger than a range, and the values are exact."""
    rng = random.Random(2)
    hot = [("hot", "20200101", rng.randint(0, 3)) for _ in range(3000)]
    cold = [(rng.choice("abc"), f"2020{rng.randint(1, 12):02}{rng.randint(1, 28):02}", rng.randint(0, 3)) for _ in range(3000)]
    rows = [(i, *r) for i, r in enumerate(hot + cold)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "i int, k string, t string, w int").withColumn("tie", F.col("i"))
    got = running(df, ["k"], ["t", "tie"], {"s": (SUM, "w", True), "before": (SUM, "w", False), "last": (MAX, "t", False)}, ranges=16)
    by = {}
    for i, k, t, w in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        s, last = by.get(k, (0, None))
        by[k] = (s + w, t)
        by[i] = (s + w, s, last)
    assert {r.i: (r.s, r.before, r.last) for r in got.collect()} == {i: by[i] for i, *_ in rows}
    # the ranges are even, whatever the key
    from notchline.operators.prefix import PART, dealt_by_range

    sizes = [r["count"] for r in dealt_by_range(df, ["k", "t", "tie"], 16).groupBy(PART).count().collect()]
    assert max(sizes) < 3 * len(rows) / 16
    # the as-of join with half of history and runs on one key-day
    hist, runs = df.select("k", F.col("t").alias("ts")), df.select("i", "k", F.col("t").alias("rt"))
    have = Counter((k, t) for _, k, t, _ in rows)
    want = {i: sum(n for (a, b), n in have.items() if a == k and b <= t) for i, k, t, _ in rows}
    assert {r.i: r.n_asof for r in asof_join(runs, hist, "k", "rt", "ts").collect()} == want
    counts = {(r.k, r.ts): (r.n_asof, r.prev_ts) for r in asof_counts(hist, "k", "ts").collect()}
    assert counts == {(k, t): (sum(n for (a, b), n in have.items() if a == k and b <= t), max((b for a, b in have if a == k and b < t), default=None)) for k, t in have}


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1300)] + [(5000, 5000), (None, 3)]
    edges += [(2000, i) for i in range(2001, 2200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("uv"), rng.randint(-60, 60), rng.randint(-60, 60), rng.randint(-25, 25)) for i in range(350)]
    rows += [(400 + i, "w", rng.randint(0, 9), rng.randint(0, 9), rng.randint(0, 4)) for i in range(120)]  # dense
    rows += [(900, None, 1, 1, 1), (901, "w", None, 1, 1)]
    rng.shuffle(rows)
    tol = (10, 9, 5)
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1] and None not in a + b and all(abs(a[2 + d] - b[2 + d]) <= tol[d] for d in range(3)):
                x, y = sorted((find(a[0]), find(b[0])))
                root[y] = x
    size = Counter(find(r[0]) for r in rows)
    df = spark.createDataFrame(rows, "i int, u string, x int, y int, z int")
    got = {r.i: (r.group_id, r.group_size) for r in near_groups(df, "i", ["u"], [("x", 10), ("y", 9), ("z", 5)]).collect()}
    assert got == {r[0]: (find(r[0]), size[find(r[0])]) for r in rows}
    one = {r.i: r.group_id for r in near_groups(df.select("i", "u", "x"), "i", ["u"], [("x", 1)]).collect()}  # a single band
    assert len(one) == len(rows)
