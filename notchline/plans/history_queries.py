
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.text import field, java_split, yyyymmdd
from notchline.operators.consolidate import micros
from notchline.operators.history import asof_counts, asof_join
from notchline.operators.lookup import first_by, prefix_join, substring_join
from notchline.operators.matching import latest_per_tool
from notchline.operators.prefix import SUM, running
from notchline.plans import model
from notchline.plans import oracle as O
from notchline.plans.registry import query
from notchline.session import scratch_path
from notchline.sources.history_store import store_history
from notchline.sources.lookups import parse_device_lines, read_arm_csv, side_eligible, with_sentinels
from notchline.sources.tables import Tables


@query(
    "device_lookup_first",
    oracle=f"""WITH {O.DEVICE_LINES},
parsed AS (SELECT line_key, line_group, line, string_split(line, ',')[2] AS name,
                  TRY_CAST(string_split(line, ',')[5] AS INTEGER) AS flat FROM device_lines),
dev AS (SELECT n_name AS device FROM nation),
firsts AS (SELECT device, line_key, flat,
                  row_number() OVER (PARTITION BY device ORDER BY line_group, line_key) AS rn
           FROM dev JOIN parsed ON contains(line, device))
SELECT d.device, f.line_key AS first_key, f.flat AS first_flat, e.line_key AS exact_key, e.flat AS exact_flat,
       (f.line_key IS DISTINCT FROM e.line_key) AS differs
FROM dev d LEFT JOIN firsts f ON f.device = d.device AND f.rn = 1
LEFT JOIN parsed e ON e.name = d.device""",
)
def device_lookup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#11: for every device id, the first reference line (in file order) whose
    text contains it -- the reference's rule -- beside the line whose name field
    equals it. ``NATION_1`` sits inside ``NATION_10``'s line, which comes first."""
    t = Tables(spark, sf_dir)
    lines = parse_device_lines(model.device_lines(t), "line")
    devices = t.nation.select(F.col("n_name").alias("device"))
    hits = substring_join(devices, lines, "device", "line")
    firsts = first_by(hits, ["device"], ["line_group", "line_key"], ["flat"]).select(
        "device", F.col("line_key").alias("first_key"), F.col("flat").alias("first_flat")
    )
    exact = lines.select(
        field(java_split(F.col("line"), ","), 1).alias("__name"),
        F.col("line_key").alias("exact_key"),
        F.col("flat").alias("exact_flat"),
    )
    out = devices.join(firsts, "device", "left").join(
        exact, F.col("device") == F.col("__name"), "left"
    )
    return out.select(
        "device", "first_key", "first_flat", "exact_key", "exact_flat",
        (~F.col("first_key").eqNullSafe(F.col("exact_key"))).alias("differs"),
    )


def arm_table(spark: SparkSession, t: Tables) -> DataFrame:
    """The arm CSV written as a text file to the shared scratch folder and read
    back through the positional parser."""
    path = scratch_path(spark, "arm_csv")
    model.arm_csv_lines(t).write.mode("overwrite").text(path)
    return read_arm_csv(spark, path)


@query(
    "arm_dimensions_clean",
    oracle=f"""WITH {O.ARM_LINES}, {O.ARM_PARSED}
SELECT arm_key, area, tool,
  coalesce(d1, {O.D(C.MISSING_DIMENSION)}) AS d1, coalesce(d2, {O.D(C.MISSING_DIMENSION)}) AS d2,
  coalesce(rot, {O.D(C.NO_ROTATION)}) AS rot, side
FROM arm_parsed""",
)
def arm_dimensions_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#12: arm rows parsed from CSV text with the reference's fallbacks: short
    lines skipped, bad or empty numbers -> -999999.0, no rotation -> 9999.0."""
    return with_sentinels(arm_table(spark, Tables(spark, sf_dir)))


@query(
    "history_prefix_scan",
    oracle=f"""WITH {O.HIST_INDEX}
SELECT c_custkey, count(i.value) AS n_index, min(i.value) AS min_value
FROM customer c LEFT JOIN hidx i ON starts_with(i.index_key, c.c_name || '_')
GROUP BY c_custkey""",
)
def history_prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#13: index rows by key prefix (the id before the separator), as an equi-join; count
    and first value per unit, units without history kept with 0."""
    t = Tables(spark, sf_dir)
    ids = t.customer.select("c_custkey", "c_name")
    j = prefix_join(ids, model.history_index(t), "c_name", "index_key", "_", how="left")
    return j.groupBy("c_custkey").agg(
        F.count("value").alias("n_index"), F.min("value").alias("min_value")
    )


@query(
    "history_fetch",
    oracle=f"""WITH {O.HIST_INDEX}, {O.HIST_ROWS}
SELECT c.c_custkey, h.rowkey, string_split(h.rowkey, '_')[1] AS hist_time,
       string_split(h.rundata, ',')[2] AS tool, string_split(h.rundata, ',')[3] AS station
FROM customer c JOIN hidx i ON starts_with(i.index_key, c.c_name || '_')
JOIN hrows h ON h.rowkey = i.value""",
)
def history_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#14: index values resolved to history rows (inner: an index entry whose row
    is missing is dropped), with time, tool and station split out of them."""
    t = Tables(spark, sf_dir)
    ids = t.customer.select("c_custkey", "c_name")
    idx = prefix_join(ids, model.history_index(t), "c_name", "index_key", "_")
    rows = model.history_rows(t)
    j = idx.join(rows, idx["value"] == rows["rowkey"])
    run = java_split(F.col("rundata"), ",")
    return j.select(
        "c_custkey",
        "rowkey",
        field(java_split(F.col("rowkey"), "_"), 0).alias("hist_time"),
        field(run, 1).alias("tool"),
        field(run, 2).alias("station"),
    )


HISTORY_BUCKETS = 16  # for the test tables; see KeyedTable.write


@query(
    "history_store_fetch",
    oracle=f"""WITH {O.HIST_INDEX}, {O.HIST_ROWS}
SELECT c.c_custkey, count(i.value) AS n_index, count(h.rowkey) AS n_rows, min(h.rowkey) AS first_row
FROM customer c LEFT JOIN hidx i ON starts_with(i.index_key, c.c_name || '_')
LEFT JOIN hrows h ON h.rowkey = i.value GROUP BY c.c_custkey""",
)
def history_store_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-7, SRC-8 on a stored history: per unit the index entries under its id and the rows
    these lead to. Index and rows are written bucketed by their keys; neither is shuffled when asked."""
    t = Tables(spark, sf_dir)
    index, rows = store_history(model.history_index(t), "index_key", model.history_rows(t), "rowkey", "_", HISTORY_BUCKETS)
    ids = t.customer.select("c_custkey", "c_name")
    found = index.of(ids, "c_name", "left").select("c_custkey", "value")
    return rows.of(found, "value", "left").groupBy("c_custkey").agg(
        F.count("value").alias("n_index"), F.count("rowkey").alias("n_rows"), F.min("rowkey").alias("first_row")
    )


@query(
    "history_asof",
    oracle="""SELECT r.o_orderkey,
  (SELECT count(*) FROM orders h WHERE h.o_custkey = r.o_custkey AND h.o_orderdate <= r.o_orderdate) AS n_asof,
  (SELECT strftime(max(h.o_orderdate), '%Y%m%d') FROM orders h
    WHERE h.o_custkey = r.o_custkey AND h.o_orderdate < r.o_orderdate) AS prev_time
FROM orders r""",
)
def history_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#15: per run, how many of its unit's runs are at or before it (ties
    included) and the unit's latest earlier run time."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    cum = asof_counts(o, "o_custkey", "o_orderdate")
    return o.join(cum, ["o_custkey", "o_orderdate"]).select(
        "o_orderkey", "n_asof", yyyymmdd(F.col("prev_ts")).alias("prev_time")
    )


@query(
    "history_asof_join",
    oracle="""WITH h AS (SELECT o_custkey AS k, l_shipdate AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT r.o_orderkey,
  (SELECT count(*) FROM h WHERE h.k = r.o_custkey AND h.ts <= r.o_orderdate) AS n_hist,
  (SELECT strftime(max(h.ts), '%Y%m%d') FROM h WHERE h.k = r.o_custkey AND h.ts <= r.o_orderdate) AS last_time
FROM orders r""",
)
def history_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-4 with runs and history as different tables: per run (order), how
    many history rows (points shipped for the same unit) are at or before the
    run's time, ties included, and the latest of them."""
    t = Tables(spark, sf_dir)
    runs = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    hist = model.history(t)
    j = asof_join(runs, hist, "o_custkey", "o_orderdate", "l_shipdate").drop("o_custkey")
    return j.select(
        "o_orderkey",
        F.coalesce("n_asof", F.lit(0)).cast("bigint").alias("n_hist"),
        yyyymmdd(F.col("last_ts")).alias("last_time"),
    )


@query(
    "history_asof_text",
    oracle="""WITH h AS (SELECT o_custkey AS k, strftime(l_shipdate, '%Y%m%d') || '_' || l_linenumber AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT r.o_orderkey,
  (SELECT count(*) FROM h WHERE h.k = r.o_custkey AND h.ts <= strftime(r.o_orderdate, '%Y%m%d') || '_4') AS n_hist,
  (SELECT max(h.ts) FROM h WHERE h.k = r.o_custkey AND h.ts <= strftime(r.o_orderdate, '%Y%m%d') || '_4') AS last_time
FROM orders r""",
)
def history_asof_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-9: JON-4 on times that are texts, as history row keys are (``yyyymmdd_<n>``), compared as texts."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    runs = o.select("o_orderkey", "o_custkey", F.concat(yyyymmdd(F.col("o_orderdate")), F.lit("_4")).alias("run_time"))
    li = t.lineitem.select("l_orderkey", F.concat(yyyymmdd(F.col("l_shipdate")), F.lit("_"), F.col("l_linenumber").cast("string")).alias("hist_time"))
    hist = li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "hist_time")
    return asof_join(runs, hist, "o_custkey", "run_time", "hist_time").select(
        "o_orderkey", F.col("n_asof").cast("bigint").alias("n_hist"), F.col("last_ts").alias("last_time")
    )


@query(
    "substring_lookup_parts",
    oracle="""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
words AS (SELECT DISTINCT lower(p_brand) AS needle FROM part WHERE p_brand IS NOT NULL
  UNION SELECT DISTINCT substr(text, 1, 12) FROM benchmark WHERE length(text) >= 12)
SELECT needle, count(*) AS n_lines, count(DISTINCT doc_id) AS n_docs, min(doc_id) AS first_doc
FROM words JOIN lines ON contains(line, needle) GROUP BY needle""",
)
def substring_lookup_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-1 under load: which lines of the document files contain a key, for keys from tables that
    grow (brands, and the beginnings of benchmark items): lines and documents per key, and the first document."""
    t = Tables(spark, sf_dir)
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    brands = t.part.select(F.lower("p_brand").alias("needle"))
    starts = t.benchmark.where(F.length("text") >= 12).select(F.substring("text", 1, 12).alias("needle"))
    hits = substring_join(brands.unionByName(starts).distinct(), lines, "needle", "line")
    return hits.groupBy("needle").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query(
    "area_lookup",
    oracle=f"""WITH {O.ARM_LINES}, {O.ARM_PARSED},
elig AS (SELECT * FROM arm_parsed WHERE side IS NULL OR side <> 'BACK'),
firsts AS (SELECT tool, area, row_number() OVER (PARTITION BY tool ORDER BY CAST(arm_key AS BIGINT), area) AS rn
           FROM elig)
SELECT s_suppkey, s_name AS tool, coalesce(f.area, 'null') AS area
FROM supplier LEFT JOIN firsts f ON f.tool = s_name AND f.rn = 1""",
)
def area_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#28: the first area (file order) of each tool among the front pass's arm
    rows; the text ``null`` when the tool has none (lists stay aligned)."""
    t = Tables(spark, sf_dir)
    arms = arm_table(spark, t).where(side_eligible(F.col("side"), C.SIDE_FRONT))
    arms = arms.withColumn("__order", F.col("arm_key").try_cast("bigint"))
    firsts = first_by(arms, ["tool"], ["__order"], ["area"]).select("tool", "area")
    tools = t.supplier.select("s_suppkey", F.col("s_name").alias("tool"))
    return tools.join(firsts, "tool", "left").select(
        "s_suppkey", "tool", F.coalesce("area", F.lit(C.AREA_ABSENT)).alias("area")
    )


@query(
    "latest_tool_lists",
    oracle=f"""WITH {O.HIST_LATEST}
SELECT o_custkey, count(*) AS n_tools,
  string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY last_ts DESC, l_suppkey DESC) AS tool_list,
  string_agg(strftime(last_ts, '%Y%m%d'), ',' ORDER BY last_ts DESC, l_suppkey DESC) AS time_list
FROM hist GROUP BY o_custkey""",
)
def latest_tool_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#29: per unit, the tools that handled it up to its latest run, once each at their
    latest time, latest first (ties: higher tool first), as comma text.

    The history is first reduced to one row per (unit, tool) by a combining
    aggregate; only then are a unit's distinct tools gathered, so a list holds at
    most one entry per tool, whatever the unit's share of the history."""
    t = Tables(spark, sf_dir)
    latest = latest_per_tool(model.history(t), model.latest_runs(t.orders), "o_custkey", "l_suppkey", "l_shipdate")
    lst = F.sort_array(F.collect_list(F.struct("last_ts", "l_suppkey")), asc=False)
    return (
        latest.groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_tools"), lst.alias("__l"))
        .select(
            "o_custkey",
            "n_tools",
            F.array_join(F.transform("__l", lambda x: x["l_suppkey"].cast("string")), ",").alias("tool_list"),
            F.array_join(F.transform("__l", lambda x: yyyymmdd(x["last_ts"])), ",").alias("time_list"),
        )
    )


@query(
    "latest_tool_ranks",
    oracle=f"""WITH {O.HIST_LATEST}
SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY last_ts DESC, l_suppkey DESC) AS rank, l_suppkey,
  strftime(last_ts, '%Y%m%d') AS last_time FROM hist""",
)
def latest_tool_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-5 as rows: per unit its tools up to its latest run, ranked from the latest on. No list is gathered: the rank is
    a running count over ranges, so a unit may have any number of tools; a sink renders text from the rows."""
    t = Tables(spark, sf_dir)
    latest = latest_per_tool(model.history(t), model.latest_runs(t.orders), "o_custkey", "l_suppkey", "l_shipdate")
    keyed = latest.withColumns({"__one": F.lit(1), "__back": -micros(F.col("last_ts")), "__tool": -F.col("l_suppkey")})
    ranked = running(keyed, ["o_custkey"], ["__back", "__tool"], {"rank": (SUM, "__one", True)})
    return ranked.select("o_custkey", F.col("rank").cast("bigint").alias("rank"), "l_suppkey", yyyymmdd(F.col("last_ts")).alias("last_time"))
