"""The end-to-end job over the smallest tables."""

import duckdb
from pyspark.sql import functions as F

from notchline.plans.job import run_job
from notchline.session import scratch_path

from .conftest import SF_SMALL


def test_job_writes_every_sink(spark):
    out = scratch_path(spark, "job")
    paths = run_job(spark, SF_SMALL, out)
    assert set(paths) == {"run_status", "image_info", "point_info", "image_summary", "y", "consolidated", "pattern"}
    status = spark.read.parquet(paths["run_status"])
    con = duckdb.connect()
    n_orders = con.execute(f"SELECT count(*) FROM '{SF_SMALL}/orders.parquet'").fetchone()[0]
    assert status.count() == n_orders
    accepted = status.where("reason IS NULL")
    analysed = accepted.where("flag").count()
    summary = spark.read.parquet(paths["image_summary"])
    # every analysed run has exactly one front and one back count entry
    counts = summary.where("qualifier IN ('NO_yES', 'BNO_yES')").groupBy("qualifier").count().collect()
    assert {r.qualifier: r["count"] for r in counts} == {"NO_yES": analysed, "BNO_yES": analysed}
    # back writer keeps only back entries
    assert summary.where("qualifier LIKE 'By%' OR qualifier = 'BNO_yES' OR qualifier LIKE 'y%' "
                         "OR qualifier = 'NO_yES'").count() == summary.count()
    pattern = spark.read.parquet(paths["pattern"])
    assert pattern.where("n > 0").count() > 0
    points = spark.read.parquet(paths["point_info"])
    assert points.select("rowkey", "qualifier").distinct().count() == points.count()
    # partitioned by device: the device directories exist
    assert "device" in points.columns
    # observed stage counts agree with the written tables
    rows = {f"{n}_rows": spark.read.parquet(p).count() for n, p in paths.items()}
    assert paths.metrics == rows | {"runs": n_orders, "accepted": accepted.count(), "analysed": analysed}
    # pattern rows only for units with an analysed run
    units = spark.read.parquet(f"{SF_SMALL}/orders.parquet").join(accepted.where("flag"), "o_orderkey").select("o_custkey").distinct()
    assert pattern.count() == units.count() > 0
    assert pattern.join(units, pattern.c_custkey == units.o_custkey, "left_anti").count() == 0
    # grid coordinates on front points only: every point of a one-sided run, front points of a two-sided one
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").join(accepted, F.col("l_orderkey") == F.col("o_orderkey"))
    last = F.max(F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")).alias("last")
    front = li.groupBy("l_orderkey", "l_linenumber", "two_sided").agg(last).where("not two_sided or last.l_linestatus <> 'O'")
    with_grid = points.where("value LIKE '%testX:%'")
    assert 0 < with_grid.count() == with_grid.where("value RLIKE ',testX:-?[0-9]+,testY:-?[0-9]+$'").count() == front.count() < points.count()
    # rows are dealt by device before the write: a few files for each device
    files = points.select("device", "_metadata.file_path").distinct().count()
    assert files <= 2 * points.select("device").distinct().count()
    y = spark.read.parquet(paths["y"])
    quals = {r.qualifier for r in y.select("qualifier").distinct().collect()}
    assert {"NO_yES", "BNO_yES", "Email_Status", "BEmail_Status", "DeviceID", "InspectionStationID"} <= quals
    assert y.where("qualifier LIKE '%Email_Status'").where("value <> '0'").count() == 0
    # one tool, time and area list per detected line, aligned
    n_lines = summary.where("qualifier RLIKE '^B?y[0-9]+$'").count()
    assert spark.read.parquet(paths["consolidated"]).select("rowkey", "side", "k").distinct().count() == n_lines
    for name in ("domain_LIST", "TIMESTAMP_LIST", "AREA_LIST"):
        assert y.where(f"qualifier RLIKE '^B?{name}[0-9]+$'").count() == n_lines
    lens = y.where("qualifier RLIKE '^B?(domain|AREA)_LIST'").selectExpr(
        "rowkey", "regexp_replace(qualifier, '(domain|AREA)_LIST', '') AS k",
        "size(split(value, ',')) AS n", "value = '' AS empty").groupBy("rowkey", "k").agg(
        {"n": "max", "empty": "max"}).count()
    assert lens == n_lines


def test_detection_lists_match_brute_force(spark):
    """The job's per-detection tool/time/area lists against a direct SQL form:
    nested-loop band predicate, side rule, history at or before each run's time."""
    from notchline.plans import oracle as O

    from .conftest import SF_CHECK

    out = scratch_path(spark, "job-lists")
    paths = run_job(spark, SF_CHECK, out)
    con = duckdb.connect()
    for t in ("orders", "lineitem", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    summ = paths["image_summary"]
    want = con.execute(f"""
    WITH s AS (SELECT rowkey, qualifier, value FROM read_parquet('{summ}/**/*.parquet', hive_partitioning=true)),
    lines AS (SELECT rowkey, CASE WHEN starts_with(qualifier, 'B') THEN 'B' ELSE '' END AS side,
        CAST(regexp_extract(qualifier, '([0-9]+)$', 1) AS INTEGER) AS k,
        CAST(regexp_extract(value, 'THETA:(-?[0-9]+)', 1) AS INTEGER) AS tb,
        CAST(regexp_extract(value, 'R:(-?[0-9]+)', 1) AS BIGINT) AS rb
      FROM s WHERE regexp_matches(qualifier, '^B?y[0-9]+$')),
    d AS (SELECT rowkey, side, k, rb * {O.D(5.0)} * {O.D(1000.0)} AS r, tb * pi() / {O.D(18)} AS theta FROM lines),
    {O.ARM},
    cand AS (SELECT d.rowkey, d.side, d.k, a.s_suppkey, a.tool, a.area FROM d JOIN arm a ON {O.band_cond()}
      AND (a.side IS NULL OR a.side <> CASE WHEN d.side = '' THEN 'BACK' ELSE 'FRONT' END)),
    held AS (SELECT c.rowkey, c.side, c.k, c.tool, c.area, max(l.l_shipdate) AS last_ts
      FROM cand c JOIN orders r ON CAST(r.o_orderkey AS VARCHAR) = c.rowkey
      JOIN lineitem l ON l.l_suppkey = c.s_suppkey
      JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_custkey = r.o_custkey
      WHERE l.l_shipdate <= r.o_orderdate GROUP BY ALL)
    SELECT rowkey, side || 'domain_LIST' || CAST(k AS VARCHAR) AS q,
      string_agg(tool, ',' ORDER BY last_ts DESC, tool DESC) AS tools,
      string_agg(strftime(last_ts, '%Y%m%d'), ',' ORDER BY last_ts DESC, tool DESC) AS times,
      string_agg(area, ',' ORDER BY last_ts DESC, tool DESC) AS areas
    FROM held GROUP BY ALL""").fetchall()
    y = spark.read.parquet(paths["y"])
    got = {}
    for r in y.where("qualifier RLIKE '^B?(domain|TIMESTAMP|AREA)_LIST' AND value <> ''").collect():
        kind = "tools" if "domain_LIST" in r.qualifier else "times" if "TIMESTAMP" in r.qualifier else "areas"
        q = r.qualifier.replace("TIMESTAMP_LIST", "domain_LIST").replace("AREA_LIST", "domain_LIST")
        got.setdefault((r.rowkey, q), {})[kind] = r.value
    assert len(want) > 0
    assert got == {(rk, q): {"tools": a, "times": b, "areas": c} for rk, q, a, b, c in want}


def test_job_ends_before_any_work_when_a_table_is_missing(spark, tmp_path):
    import pytest

    with pytest.raises(LookupError, match="supplier"):
        for name in ("orders", "customer", "lineitem", "nation"):
            (tmp_path / f"{name}.parquet").symlink_to(f"{SF_SMALL}/{name}.parquet")
        run_job(spark, str(tmp_path), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_retention_keeps_the_young_runs(spark):
    out = scratch_path(spark, "job-young")
    paths = run_job(spark, SF_SMALL, out, retain_days=360)
    newest = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr("max(o_orderdate) AS m").first().m
    info = spark.read.parquet(paths["image_info"]).where("qualifier = 'ConvertedTimestamp'")
    assert info.count() > 0
    assert info.selectExpr("min(value)").first()[0] >= f"{newest.replace(year=newest.year - 1):%Y%m%d}"


def test_devices_and_header_come_from_the_texts(spark):
    out = scratch_path(spark, "job-header")
    paths = run_job(spark, SF_SMALL, out)
    names = {r[0] for r in spark.read.parquet(f"{SF_SMALL}/nation.parquet").select("n_name").collect()}
    for name in ("run_status", "image_info", "point_info", "image_summary", "y", "consolidated", "pattern"):
        devices = {r[0] for r in spark.read.parquet(paths[name]).where("device IS NOT NULL").select("device").distinct().collect()}
        assert devices and (devices <= names or name == "run_status")
    info = spark.read.parquet(paths["image_info"])
    assert {r[0] for r in info.select("qualifier").distinct().collect()} == {"DeviceID", "imageID", "InspectionStationID", "domainType", "DiePitchX", "domainarge", "ConvertedTimestamp"}
    assert info.where("qualifier = 'DeviceID' AND value <> device").count() == 0


def test_stage_times_are_stored(spark):
    out = scratch_path(spark, "job-times")
    for _ in range(2):
        paths = run_job(spark, SF_SMALL, out)
    rows = spark.read.parquet(paths.stages).collect()
    assert len({r.launch for r in rows}) == 2
    last = {r.stage: r for r in rows if r.launch == max(x.launch for x in rows)}
    assert set(last) == {"parse", *paths} and all(r.seconds > 0 for r in rows)
    assert {s: r.n_rows for s, r in last.items() if s != "parse"} == {n: paths.metrics[f"{n}_rows"] for n in paths}
    assert last["parse"].started < last["run_status"].started < last["pattern"].started


def test_a_second_launch_puts_into_the_tables_of_the_first(spark, tmp_path):
    """The first launch sees the older half of the runs, the second all: the tables end as after one launch of all,
    and a cell that only the first wrote stays."""
    out, whole = scratch_path(spark, "job-put"), scratch_path(spark, "job-whole")
    half = tmp_path / "half"
    half.mkdir()
    for name in ("customer", "lineitem", "nation", "supplier"):
        (half / f"{name}.parquet").symlink_to(f"{SF_SMALL}/{name}.parquet")
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 2 = 0").write.parquet(str(half / "orders.parquet"))
    run_job(spark, str(half), out, put=True)
    first = spark.read.parquet(f"{out}/point_info").count()
    run_job(spark, SF_SMALL, out, put=True)
    run_job(spark, SF_SMALL, whole)
    for name in ("run_status", "image_info", "point_info", "image_summary"):
        a, b = spark.read.parquet(f"{out}/{name}"), spark.read.parquet(f"{whole}/{name}")
        assert a.count() == b.count() > 0 and a.select(b.columns).exceptAll(b).count() == 0
    assert first < spark.read.parquet(f"{out}/point_info").count()


def test_parameter_files_drive_the_detection(spark):
    import pytest

    from notchline.operators.patterns import summarize_runs
    from notchline.plans import model
    from notchline.plans.job import parameter_set
    from notchline.sources.tables import Tables

    t = Tables(spark, SF_SMALL)
    params = model.parameter_files(spark, t, scratch_path(spark, "params"))
    sets = [parameter_set(spark, params, k) for k in range(5)]
    assert [(s.angles, s.r_bin, s.least_votes, s.offset) for s in sets] == [(6 + 2 * k, 4.0 + k, 3 + k % 2, 10.0 * (k + 1)) for k in range(5)]
    with pytest.raises(LookupError):
        parameter_set(spark, params, 9)
    out = scratch_path(spark, "job-params")
    paths = run_job(spark, SF_SMALL, out, params=params, profile=3)
    plain = run_job(spark, SF_SMALL, scratch_path(spark, "job-plain"))
    got = spark.read.parquet(paths["image_summary"]).select("rowkey", "qualifier", "value")
    assert got.exceptAll(spark.read.parquet(plain["image_summary"]).select("rowkey", "qualifier", "value")).count() > 0
    # the same as summarising the runs of one side by these numbers
    runs = spark.read.parquet(paths["run_status"]).where("reason IS NULL AND flag AND NOT two_sided").select(F.col("o_orderkey").alias("run_id"))
    pts = runs.join(model.points(t), "run_id")
    want = summarize_runs(pts, "run_id", "x", "y", bins=12, r_bin=7.0, least_votes=4).select(F.col("run_id").cast("string").alias("rowkey"), "qualifier", "value")
    mine = got.where("NOT qualifier LIKE 'B%'").join(pts.select(F.col("run_id").cast("string").alias("rowkey")).distinct(), "rowkey", "left_semi").select("rowkey", "qualifier", "value")
    assert want.count() == mine.count() > 0 and want.exceptAll(mine).count() == 0
