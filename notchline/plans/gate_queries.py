
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.geometry import rotate_grid
from notchline.functions.text import field, java_split
from notchline.operators.gates import eligibility_flag, first_reason, reference_checks, station_tag, two_sided
from notchline.operators.lookup import lookup_first_line
from notchline.plans import model
from notchline.plans import oracle as O
from notchline.plans.parsed import ParsedFiles
from notchline.plans.registry import query
from notchline.session import scratch_path
from notchline.sources.lookups import parse_device_lines
from notchline.sources.tables import Tables, missing_reason

# Stand-in station codes: o_orderpriority plays the station text.
SPECIAL = ("URGENT",)
PRODUCTION = ("HIGH", "MEDIUM")
MAC = ("HIGH",)
TWO_SIDED = "HIGH"
TAG_ABSENT = ("LOW", "MEDIUM")
TAG_PRESENT = ("URGENT",)
TAG_TYPE = "SPECIFIED"

_CLS = "CASE l_returnflag WHEN 'R' THEN -1 WHEN 'A' THEN 1 ELSE 0 END"


def point_stats(t: Tables) -> DataFrame:
    """Per-run point aggregates, computed once on the point table before any join
    (partial aggregation runs map-side, so a hot run is combined before the shuffle)."""
    back = F.col("l_linestatus") == "O"
    cls = F.abs(model.point_class())
    return t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(back, F.lit(1))).alias("n_back"),
        F.sum(cls).cast("bigint").alias("j_all"),
        F.sum(F.when(~back, cls).otherwise(F.lit(0))).cast("bigint").alias("j_front"),
    )


def station_stats(t: Tables) -> DataFrame:
    """Runs with their station and point aggregates."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    s = point_stats(t)
    return o.join(s, o.o_orderkey == s.l_orderkey, "left")


def runs_with_stats(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    return station_stats(t).join(c, F.col("o_custkey") == F.col("c_custkey"), "left")


def standin_version() -> F.Column:
    return F.when(F.col("o_orderkey") % 2 == 0, F.lit(C.DIALECT_NEW)).otherwise(F.lit(C.DIALECT_OLD))


def reason(maxpoint: int = C.MAXPOINT) -> F.Column:
    """The first gate that fires, over ``runs_with_stats`` columns."""
    v = standin_version()
    pr = F.col("o_orderpriority")
    checks = [
        ("excluded_type", (v == C.DIALECT_NEW) & (pr == "4-NOT SPECIFIED")),
        ("placeholder", (v == C.DIALECT_OLD) & (pr == "5-LOW")),
        ("missing_device", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).isNull()),
        ("bad_id_length", F.length(F.col("o_orderkey").cast("string")) < 3),
        ("too_many_points", F.coalesce(F.col("n_all"), F.lit(0)) > maxpoint),
        ("no_flat_position", F.col("c_nationkey") % 5 == 4),
    ]
    return first_reason(checks)


def reasons(t: Tables) -> DataFrame:
    return runs_with_stats(t).select("o_orderkey", reason().alias("reason"))


_REASON_SQL = f"""WITH pts AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
rs AS (SELECT o_orderkey, CASE
    WHEN o_orderkey % 2 = 0 AND o_orderpriority = '4-NOT SPECIFIED' THEN 'excluded_type'
    WHEN o_orderkey % 2 <> 0 AND o_orderpriority = '5-LOW' THEN 'placeholder'
    WHEN nullif(c_mktsegment, 'BUILDING') IS NULL THEN 'missing_device'
    WHEN length(CAST(o_orderkey AS VARCHAR)) < 3 THEN 'bad_id_length'
    WHEN coalesce(p.n, 0) > {C.MAXPOINT} THEN 'too_many_points'
    WHEN c_nationkey % 5 = 4 THEN 'no_flat_position' END AS reason
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN pts p ON p.l_orderkey = o_orderkey)"""


@query("quarantine_reason", oracle=f"{_REASON_SQL}\nSELECT o_orderkey, reason FROM rs")
def quarantine_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#16: the first gate that fires per run, in the reference's order; null when clean."""
    return reasons(Tables(spark, sf_dir))


@query(
    "status_counts",
    oracle=f"{_REASON_SQL}\nSELECT coalesce(reason, 'ok') AS reason, count(*) AS n_runs FROM rs GROUP BY 1",
)
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#17: runs per outcome (the reference collects per-file flags and drops them)."""
    r = reasons(Tables(spark, sf_dir))
    return r.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_runs")
    )


@query(
    "point_cap",
    oracle=f"""SELECT l_orderkey, count(*) AS n_points FROM lineitem GROUP BY l_orderkey
HAVING count(*) > {C.MAXPOINT}""",
)
def point_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#18: runs whose point count exceeds MAXPOINT."""
    li = Tables(spark, sf_dir).lineitem
    return (
        li.groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_points"))
        .where(F.col("n_points") > C.MAXPOINT)
    )


@query(
    "class_abs_sum",
    oracle=f"""SELECT l_orderkey, CAST(sum(abs({_CLS})) AS BIGINT) AS class_abs_sum
FROM lineitem GROUP BY l_orderkey""",
)
def class_abs_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#19: sum of |class| per run."""
    li = Tables(spark, sf_dir).lineitem
    return li.groupBy("l_orderkey").agg(
        F.sum(F.abs(model.point_class())).cast("bigint").alias("class_abs_sum")
    )


@query(
    "station_flag",
    oracle=f"""WITH pts AS (
  SELECT l_orderkey, sum(abs({_CLS})) AS j_all,
         sum(CASE WHEN l_linestatus <> 'O' THEN abs({_CLS}) ELSE 0 END) AS j_front
  FROM lineitem GROUP BY l_orderkey),
r AS (SELECT o_orderkey, o_orderpriority AS st,
  CAST(coalesce(CASE WHEN contains(o_orderpriority, 'HIGH') THEN j_front ELSE j_all END, 0) AS BIGINT) AS j
  FROM orders LEFT JOIN pts ON l_orderkey = o_orderkey)
SELECT o_orderkey, j,
  CASE WHEN j > 0 AND NOT contains(st, 'HIGH') THEN false
       WHEN contains(st, 'URGENT') THEN true
       WHEN contains(st, 'HIGH') OR contains(st, 'MEDIUM') THEN true
       ELSE false END AS flag,
  ((NOT contains(st, 'LOW') AND NOT contains(st, 'MEDIUM') AND contains(st, 'URGENT'))
   OR contains(st, 'SPECIFIED')) AS tag
FROM r""",
)
def station_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#20: eligibility flag (FLT-9, class sum over front points only on two-sided
    stations) and the review tag (FLT-7), per run."""
    t = Tables(spark, sf_dir)
    r = station_stats(t)
    st = F.col("o_orderpriority")
    j = F.coalesce(
        F.when(two_sided(st, TWO_SIDED), F.col("j_front")).otherwise(F.col("j_all")), F.lit(0)
    ).cast("bigint")
    return r.select("o_orderkey", st.alias("st"), j.alias("j")).select(
        "o_orderkey",
        "j",
        eligibility_flag(F.col("st"), F.col("j"), SPECIAL, PRODUCTION, MAC).alias("flag"),
        station_tag(F.col("st"), F.col("st"), TAG_ABSENT, TAG_PRESENT, TAG_TYPE).alias("tag"),
    )


@query(
    "side_split",
    oracle="""WITH pts AS (SELECT l_orderkey, count(*) AS n_all,
    count(*) FILTER (WHERE l_linestatus = 'O') AS n_back FROM lineitem GROUP BY l_orderkey),
r AS (SELECT o_orderkey, contains(o_orderpriority, 'HIGH') AS two,
    coalesce(n_all, 0) AS n_all, coalesce(n_back, 0) AS n_back
  FROM orders LEFT JOIN pts ON l_orderkey = o_orderkey)
SELECT o_orderkey, '' AS side, CASE WHEN two THEN n_all - n_back ELSE n_all END AS n_points FROM r
UNION ALL
SELECT o_orderkey, 'B' AS side, CASE WHEN two THEN n_back ELSE 0 END AS n_points FROM r""",
)
def side_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#21: point count per run and side; one-sided runs put every point on the
    front and keep a zero row for the back."""
    t = Tables(spark, sf_dir)
    r = station_stats(t)
    two = two_sided(F.col("o_orderpriority"), TWO_SIDED)
    n_all = F.coalesce(F.col("n_all"), F.lit(0))
    n_back = F.coalesce(F.col("n_back"), F.lit(0))
    sides = F.array(
        F.struct(F.lit(C.SIDE_FRONT).alias("side"), F.when(two, n_all - n_back).otherwise(n_all).alias("n_points")),
        F.struct(F.lit(C.SIDE_BACK).alias("side"), F.when(two, n_back).otherwise(F.lit(0)).cast("bigint").alias("n_points")),
    )
    return r.select("o_orderkey", F.inline(sides))


@query(
    "append_grid_xy",
    oracle=f"""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_linenumber % 4 * 90 AS INTEGER) AS flat,
    CAST(round(l_quantity) AS INTEGER) AS x,
    CAST(round(l_discount * CAST(100 AS DOUBLE)) AS INTEGER) AS y FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, flat,
  CASE flat WHEN 90 THEN -y WHEN 180 THEN -x WHEN 270 THEN y ELSE x END AS test_x,
  CASE flat WHEN 90 THEN x WHEN 180 THEN -y WHEN 270 THEN -x ELSE y END AS test_y
FROM p""",
)
def append_grid_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#22: grid coordinates of each point rotated by its flat position (PRJ-5)."""
    li = Tables(spark, sf_dir).lineitem
    p = li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        ((F.col("l_linenumber") % 4) * 90).alias("flat"),
        F.round("l_quantity").cast("int").alias("x"),
        F.round(F.col("l_discount") * 100.0).cast("int").alias("y"),
    )
    gx, gy = rotate_grid(F.col("x"), F.col("y"), F.col("flat"))
    return p.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flat",
        gx.alias("test_x"), gy.alias("test_y"),
    )


def device_table(spark: SparkSession, t: Tables) -> DataFrame:
    """The device reference as a CSV file in the shared folder, read back and parsed (SRC-4)."""
    path = scratch_path(spark, "device_csv")
    model.device_lines(t).select("line").write.text(path)
    lines = parse_device_lines(spark.read.text(path))
    part = java_split(F.col("value"), ",")
    return lines.select(
        "value", "flat", field(part, 2).try_cast("int").alias("line_group"), field(part, 0).try_cast("int").alias("line_key")
    )


def text_gates(spark: SparkSession, t: Tables, facts: DataFrame, maxpoint: int = C.MAXPOINT) -> DataFrame:
    """UDF-3's first half from parsed files (``facts``): header fields -> device lookup -> gates,
    one row per run with the header's device, type and station, the flat position,
    the point counts and class sums, and the first failing gate."""
    header = F.col("header")
    runs = facts.withColumn("device", F.element_at(header, F.lit("DeviceID")))
    runs = lookup_first_line(runs, "device", device_table(spark, t), "value", ["line_group", "line_key"], ["flat"])
    checks = reference_checks(header, F.col("version"), F.col("n_all"), F.col("flat"), maxpoint)
    return runs.select(
        "o_orderkey",
        "device",
        F.element_at(header, F.lit(C.TYPE_FIELD)).alias("type"),
        F.element_at(header, F.lit(C.STATION_FIELD)).alias("station"),
        "flat", "n_all", "n_back", "j_all", "j_front",
        first_reason(checks).alias("reason"),
    )


@query(
    "gates_from_text",
    oracle=f"""WITH {O.DEVICE_LINES},
pts AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
r AS (SELECT o_orderkey, o_orderpriority AS station,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '{C.EXCLUDED_TYPE}' ELSE 'SCAN' END AS type,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN CASE WHEN c_nationkey % 5 = 4 THEN 'UNLISTED-' || c_nationkey ELSE n_name END END AS device,
    coalesce(n, 0) AS n
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN pts ON l_orderkey = o_orderkey),
f AS (SELECT device, arg_min(string_split(line, ',')[5]::INTEGER, (line_group, line_key)) AS flat
  FROM (SELECT DISTINCT device FROM r) JOIN device_lines ON contains(line, device) GROUP BY device)
SELECT o_orderkey, r.device, type, station, flat, CASE
    WHEN o_orderkey % 2 = 0 AND (type = '{C.EXCLUDED_TYPE}' OR o_orderkey % 97 = 0) THEN 'excluded_type'
    WHEN o_orderkey % 2 <> 0 AND station = '5-LOW' THEN 'placeholder'
    WHEN r.device IS NULL THEN 'missing_device'
    WHEN o_orderkey < 100 THEN 'bad_id_length'
    WHEN n > {C.MAXPOINT} THEN 'too_many_points'
    WHEN flat IS NULL THEN 'no_flat_position' END AS reason
FROM r LEFT JOIN f ON f.device = r.device""",
)
def gates_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2..FLT-8 on parsed file texts, with the device reference read from a CSV. Texts are
    parsed once into a stored table; the gates and the device lookup read that."""
    t = Tables(spark, sf_dir)
    return text_gates(spark, t, ParsedFiles(spark, t).facts()).select("o_orderkey", "device", "type", "station", "flat", "reason")


# lines of a run's file before its first point
_HEAD_SQL = """9 + CASE WHEN c_mktsegment <> 'BUILDING' AND n_name IS NOT NULL THEN 1 ELSE 0 END
    + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END"""


@query(
    "points_from_text",
    oracle=f"""WITH pts AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) AS place
  FROM lineitem),
kept AS (SELECT p.*, CASE WHEN o_orderkey % 2 = 0 THEN {C.SCALE_NEW} ELSE {C.SCALE_OLD} END AS scale
  FROM pts p JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  WHERE place + {_HEAD_SQL} <= CASE WHEN o_orderkey % 2 = 0 THEN {C.LINE_CAP_NEW} ELSE {C.LINE_CAP_OLD} END),
one AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY place DESC) AS rn FROM kept)
SELECT l_orderkey AS o_orderkey, 'point' || l_linenumber AS qualifier,
  'ID:' || l_linenumber || ',PART:' || l_partkey || ',SUPP:' || l_suppkey || ',FLAG:' || l_returnflag || l_linestatus
    || ',X:' || CAST(CAST(CAST(l_quantity AS DECIMAL(20,6)) / scale AS DECIMAL(20,6)) AS VARCHAR)
    || ',Y:' || CAST(CAST(CAST(l_discount * 100 AS DECIMAL(20,6)) / scale AS DECIMAL(20,6)) AS VARCHAR) AS value,
  round(l_quantity, 6) AS x, round(l_discount * 100, 6) AS y, l_returnflag || l_linestatus AS flag
FROM one WHERE rn = 1""",
)
def points_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-17, FLT-6, SNK-3: every run's points out of its file text: the lines of its point list up to the
    dialect's line cap, the last of an id, as name:value text and as scaled numbers."""
    points = ParsedFiles(spark, Tables(spark, sf_dir)).last_points()
    return points.select("o_orderkey", F.col("name").alias("qualifier"), "value", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "flag")


@query(
    "missing_table_reason",
    oracle="""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN 'missing_table imagehist' END AS reason FROM orders""",
)
def missing_table_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9 as a gate (reason 7): runs of the older dialect ask for a history table that is not there and get
    that as their reason; the others' tables are there."""
    t = Tables(spark, sf_dir)
    there, absent = (missing_reason(spark, sf_dir, names) for names in (["orders", "lineitem"], ["orders", "imagehist"]))
    old = standin_version() == C.DIALECT_OLD
    return t.orders.select("o_orderkey", F.when(old, absent).otherwise(there).alias("reason"))
