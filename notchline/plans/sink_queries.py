
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notchline import constants as C
from notchline.functions.text import key_of_fields, point_fields, render_fields, yyyymmdd
from notchline.operators.gates import eligibility_flag, two_sided
from notchline.plans import gate_queries as G
from notchline.plans import model
from notchline.plans import oracle as O
from notchline.plans.matching_queries import attribution
from notchline.plans.registry import query
from notchline.session import scratch_path
from notchline.operators.sinks import (
    batch_counts,
    keep_last,
    last_put,
    map_of,
    retained,
    retention_filter,
    unpivot_long,
    upsert,
    write_partitioned,
)
from notchline.sources.tables import Tables


@query(
    "points_last_wins",
    oracle="""SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS ship_time,
  l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
WHERE rn = 1""",
)
def points_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#31: one point per (run, point id), the last by (time, part, supplier),
    as a later map put overwrites an earlier one."""
    li = Tables(spark, sf_dir).lineitem
    kept = keep_last(
        li,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
        ["l_quantity", "l_returnflag", "l_linestatus"],
    )
    return kept.select(
        "l_orderkey", "l_linenumber", yyyymmdd(F.col("l_shipdate")).alias("ship_time"),
        "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus",
    )


POINT_HEADER = ("ID", "PART", "SUPP", "FLAG")


@query(
    "points_kv_render",
    oracle="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  'point' || CAST(l_linenumber AS VARCHAR) AS point_key,
  'ID:' || CAST(l_linenumber AS VARCHAR) || ',PART:' || CAST(l_partkey AS VARCHAR) ||
  ',SUPP:' || CAST(l_suppkey AS VARCHAR) || ',FLAG:' || l_returnflag || ' ' || l_linestatus AS rendered
FROM lineitem""",
)
def points_kv_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#32: each point's text split on blank runs into as many fields as the
    header has names (the last takes the rest: ``FLAG:A F``) and rendered as
    ``name:value`` pairs."""
    li = Tables(spark, sf_dir).lineitem
    text = F.concat_ws(
        " ",
        *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")],
        "l_returnflag",
        "l_linestatus",
    )
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        point_fields(text, len(POINT_HEADER)).alias("__f"),
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        key_of_fields(F.col("__f")).alias("point_key"),
        render_fields(F.col("__f"), POINT_HEADER).alias("rendered"),
    )


@query(
    "point_batches",
    oracle=f"""SELECT l_suppkey, CAST(floor((rn - 1) / {C.BATCH}) AS INTEGER) AS batch, count(*) AS n_rows
FROM (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey
        ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey) AS rn FROM lineitem)
GROUP BY ALL""",
)
def point_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#33: rows per write batch of BATCH rows, per supplier."""
    li = Tables(spark, sf_dir).lineitem
    counts = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return batch_counts(counts, "l_suppkey", "n", C.BATCH)


_INFO_COLS = ("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "info_long_rows",
    oracle="\nUNION ALL\n".join(
        f"SELECT c_name AS rowkey, '{c}' AS qualifier, "
        + (
            "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)"
            if c == "c_acctbal"
            else f"CAST({c} AS VARCHAR)"
        )
        + f" AS value FROM customer WHERE {c} IS NOT NULL"
        for c in _INFO_COLS
    ),
)
def info_long_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#34: the header map of each unit as long (rowkey, qualifier, value) rows."""
    c = Tables(spark, sf_dir).customer.select(
        "c_name", "c_custkey", "c_nationkey",
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment",
    )
    return unpivot_long(c, "c_name", _INFO_COLS).withColumnRenamed("c_name", "rowkey")


@query(
    "pattern_row",
    oracle=f"""WITH {O.DET}, {O.ARM}, {O.HIST_LATEST}, {O.ATTR},
agg AS (SELECT c_custkey, count(*) AS n,
  string_agg(tool, ',' ORDER BY last_ts DESC, tool DESC) AS tool_list,
  string_agg(strftime(last_ts, '%Y%m%d'), ',' ORDER BY last_ts DESC, tool DESC) AS time_list,
  string_agg(area, ',' ORDER BY last_ts DESC, tool DESC) AS area_list
  FROM attr GROUP BY c_custkey)
SELECT c.c_custkey, coalesce(a.n, 0) AS n, coalesce(a.tool_list, '') AS tool_list,
  coalesce(a.time_list, '') AS time_list, coalesce(a.area_list, '') AS area_list,
  c.c_mktsegment AS device, u.station,
  -- puts in order: '1' when there are matches, then '0' always; the later put wins
  '0' AS status
FROM customer c LEFT JOIN agg a ON a.c_custkey = c.c_custkey LEFT JOIN runs u ON u.o_custkey = c.c_custkey""",
)
def pattern_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#35: one pattern row per unit, with or without matches: match count, the
    tool / time / area lists in one order (latest first), device, the station of its latest
    run, and the status cell after its two puts (the later ``0`` wins, as in the reference)."""
    t = Tables(spark, sf_dir)
    return pattern_rows(t, model.latest_runs(t.orders), "left")


def pattern_rows(t: Tables, runs: DataFrame, how: str) -> DataFrame:
    """Pattern rows of the units that have a run in ``runs`` (``how`` 'inner'), or of all units. The
    device is that of the run where ``runs`` has one, else the unit's."""
    lst = F.sort_array(F.collect_list(F.struct("last_ts", "tool", "area")), asc=False)  # bounded by the arms within the band
    agg = attribution(t, runs).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"), lst.alias("__l"))
    of_run = ["device"] if "device" in runs.columns else []
    units = t.customer.select("c_custkey", *[F.col("c_mktsegment").alias("device")] * (not of_run))
    units = units.join(runs.select(F.col("o_custkey").alias("c_custkey"), "station", *of_run), "c_custkey", how)
    j = units.join(agg, "c_custkey", "left")

    def joined(f):
        return F.coalesce(F.array_join(F.transform("__l", f), ","), F.lit(""))

    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    puts = F.array(
        F.struct(F.lit(1).alias("seq"), F.when(n > 0, F.lit("1")).alias("value")),
        F.struct(F.lit(2).alias("seq"), F.lit("0").alias("value")),
    )
    return j.select(
        "c_custkey",
        n.alias("n"),
        joined(lambda x: x["tool"]).alias("tool_list"),
        joined(lambda x: yyyymmdd(x["last_ts"])).alias("time_list"),
        joined(lambda x: x["area"]).alias("area_list"),
        "device",
        "station",
        last_put(puts).alias("status"),
    )


@query(
    "sink_by_device",
    oracle="""SELECT c_mktsegment AS device, count(*) AS n_rows
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def sink_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#36: run rows written as one table partitioned by device to the shared
    scratch folder, read back, counted per partition."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", F.col("c_mktsegment").alias("device"))
    rows = o.join(c, o.o_custkey == c.c_custkey).drop("c_custkey")
    path = scratch_path(spark, "by_device")
    write_partitioned(rows, path, "device")
    schema = T.StructType(rows.schema.fields)
    back = spark.read.schema(schema).parquet(path)
    return back.groupBy("device").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "upsert_last_status",
    oracle="""SELECT user_id, event_type AS last_event_type,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS last_time
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
)
def upsert_last_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#37: the last status per entity by (time, id): last-wins upsert."""
    e = Tables(spark, sf_dir).events
    kept = keep_last(e, ["user_id"], ["ts", "event_id"], ["event_type"])
    return kept.select(
        "user_id",
        F.col("event_type").alias("last_event_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_time"),
    )


@query(
    "retention_filter",
    oracle=f"""SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') AS order_time FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL {C.RETAIN_DAYS} DAY""",
)
def retention_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#38: rows within the retention (360 days) of the newest row."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    kept = retention_filter(o, "o_orderdate", C.RETAIN_DAYS)
    return kept.select("o_orderkey", "o_custkey", yyyymmdd(F.col("o_orderdate")).alias("order_time"))


_CELL = "SELECT user_id, event_type, value, ts, event_id, CASE WHEN event_id % 3 = 0 AND event_type <> 'view' THEN 2 ELSE 1 END AS run FROM events"


@query(
    "upsert_runs",
    oracle=f"""SELECT user_id, event_type, value, event_id, run FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY run DESC, ts DESC, event_id DESC) AS rn FROM ({_CELL}))
WHERE rn = 1""",
)
def upsert_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6, SNK-7 across runs: cells (entity, kind) put into a table partitioned by kind, by two
    runs; the second run's cell wins over the first's, inside a run the latest. Kind ``view`` is not touched by the
    second run, so its partition is neither read nor written again."""
    e = Tables(spark, sf_dir).events.select("user_id", "event_type", "value", "ts", "event_id")
    second = (F.col("event_id") % 3 == 0) & (F.col("event_type") != "view")
    path = scratch_path(spark, "upsert")
    for run, rows in ((1, e.where(~second)), (2, e.where(second))):
        upsert(rows.withColumn("run", F.lit(run)), path, ["user_id"], "event_type", ["ts", "event_id"])
    schema = e.withColumn("run", F.lit(0)).schema
    return spark.read.schema(schema).parquet(path).select("user_id", "event_type", "value", "event_id", "run")


@query(
    "retention_partitions",
    oracle=f"""SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') AS order_time FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL {C.RETAIN_DAYS} DAY""",
)
def retention_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8 as a partition drop: runs written by month; months past the retention go as
    directories, and the rest is read with a partition filter."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    rows = o.withColumn("month", F.trunc("o_orderdate", "month"))
    path = scratch_path(spark, "by_month")
    write_partitioned(rows, path, "month")
    kept = retained(spark, path, rows.schema, "month", "o_orderdate", C.RETAIN_DAYS)
    return kept.select("o_orderkey", "o_custkey", yyyymmdd(F.col("o_orderdate")).alias("order_time"))


_STATION_JOB = f"""flags AS (
  SELECT o.*, CASE WHEN coalesce(CASE WHEN contains(o_orderpriority, 'HIGH') THEN j_front ELSE j_all END, 0) > 0
      AND NOT contains(o_orderpriority, 'HIGH') THEN false
    ELSE contains(o_orderpriority, 'URGENT') OR contains(o_orderpriority, 'HIGH') OR contains(o_orderpriority, 'MEDIUM') END AS flag
  FROM orders o LEFT JOIN (SELECT l_orderkey, sum(abs({G._CLS})) AS j_all,
      sum(CASE WHEN l_linestatus <> 'O' THEN abs({G._CLS}) ELSE 0 END) AS j_front FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey),
runs AS (SELECT o_custkey, o_orderdate AS run_ts, o_orderpriority AS station FROM flags WHERE flag
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


@query(
    "pattern_row_flagged",
    oracle=f"""WITH {O.DET}, {O.ARM}, {O.HIST_LATEST.replace(O.RUNS, _STATION_JOB)}, {O.ATTR},
agg AS (SELECT c_custkey, count(*) AS n,
  string_agg(tool, ',' ORDER BY last_ts DESC, tool DESC) AS tool_list,
  string_agg(strftime(last_ts, '%Y%m%d'), ',' ORDER BY last_ts DESC, tool DESC) AS time_list,
  string_agg(area, ',' ORDER BY last_ts DESC, tool DESC) AS area_list FROM attr GROUP BY c_custkey)
SELECT c.c_custkey, coalesce(a.n, 0) AS n, coalesce(a.tool_list, '') AS tool_list, coalesce(a.time_list, '') AS time_list,
  coalesce(a.area_list, '') AS area_list, c.c_mktsegment AS device, u.station, '0' AS status
FROM customer c JOIN runs u ON u.o_custkey = c.c_custkey LEFT JOIN agg a ON a.c_custkey = c.c_custkey""",
)
def pattern_row_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-14: pattern rows of the units with a run that is eligible for analysis, as of the
    latest such run."""
    t = Tables(spark, sf_dir)
    st = F.col("o_orderpriority")
    j = F.coalesce(F.when(two_sided(st, G.TWO_SIDED), F.col("j_front")).otherwise(F.col("j_all")), F.lit(0))
    runs = t.orders.join(G.point_stats(t), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    flagged = runs.where(eligibility_flag(st, j, G.SPECIAL, G.PRODUCTION, G.MAC)).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return pattern_rows(t, model.latest_runs(flagged), "inner")


@query(
    "grouped_point_map",
    oracle="""SELECT l_orderkey, count(*) AS n, string_agg('point' || l_linenumber || '=' || l_partkey, ';' ORDER BY 'point' || l_linenumber) AS points
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
WHERE rn = 1 GROUP BY l_orderkey""",
)
def grouped_point_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-8: the points of every run as one map, point id to part, the last put of an id; shown as text."""
    li = Tables(spark, sf_dir).lineitem
    kept = keep_last(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"], ["l_quantity"])
    named = kept.select("l_orderkey", F.concat(F.lit(C.Q_POINT), F.col("l_linenumber").cast("string")).alias("name"), F.col("l_partkey").cast("string").alias("value"))
    entries = F.transform(F.map_entries("map"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return map_of(named, ["l_orderkey"], "name", "value").select("l_orderkey", F.size("map").cast("bigint").alias("n"), F.array_join(entries, ";").alias("points"))
