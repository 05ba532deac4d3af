
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.geometry import angle_direct, pi
from notchline.operators.band_join import band_counts, band_join
from notchline.operators.consolidate import consolidate, micros, near_groups
from notchline.operators.patterns import (
    density_grid,
    density_levels,
    detect_lines,
    info_keys_filter,
    is_count_qualifier,
    line_peaks,
    pattern_table_filter,
    profile_lines,
    profile_table,
    round6,
    side_writer_filter,
    summarize_runs,
)
from notchline.plans import model
from notchline.plans.oracle import D
from notchline.plans.registry import query
from notchline.session import scratch_path
from notchline.sources.lookups import read_properties
from notchline.sources.tables import Tables

# ---- SQL builders -------------------------------------------------------------

POINTS_SQL = f"""pts AS (SELECT l_orderkey AS run_id, l_quantity AS x, l_discount * {D(100)} AS y,
  l_linestatus = 'O' AS is_back FROM lineitem)"""


def bin_sql(v: str, width: float) -> str:
    """SQL twin of ``patterns.bin_of``."""
    return f"CAST(floor(floor(({v}) * {D(1e6)} + {D(0.5)}) / {D(width * 1e6)}) AS BIGINT)"


def lines_sql(src: str, name: str, where: str = "TRUE") -> str:
    """CTEs ``{name}_v`` (votes) and ``{name}`` (all lines) over points CTE ``src``."""
    return f"""{name}_v AS (
  SELECT run_id, CAST(k AS INTEGER) AS theta_bin,
    {bin_sql(f"x * cos(k * pi() / {D(C.THETA_BINS)}) + y * sin(k * pi() / {D(C.THETA_BINS)})", C.R_BIN)} AS r_bin
  FROM {src}, range({C.THETA_BINS}) t(k) WHERE {where}),
{name} AS (
  SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY count(*) DESC, theta_bin, r_bin) AS INTEGER)
    AS line_no, theta_bin, r_bin, count(*) AS votes
  FROM {name}_v GROUP BY run_id, theta_bin, r_bin HAVING count(*) >= {C.MIN_VOTES})"""


def entries_sql(lines: str, side: str) -> str:
    return f"""SELECT r.run_id, '{side}{C.Q_COUNT}' AS qualifier, CAST(count(d.run_id) AS VARCHAR) AS value
FROM runs r LEFT JOIN {lines} d ON d.run_id = r.run_id GROUP BY r.run_id
UNION ALL
SELECT run_id, '{side}{C.Q_DETECTION}' || CAST(line_no AS VARCHAR) AS qualifier,
  'THETA:' || CAST(theta_bin AS VARCHAR) || ',R:' || CAST(r_bin AS VARCHAR) AS value FROM {lines}"""


def _points(t: Tables) -> DataFrame:
    return model.points(t)


@query("detect_lines", oracle=f"WITH {POINTS_SQL}, {lines_sql('pts', 'det')}\nSELECT * FROM det")
def detect_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#23: every line of every run (bins with at least MIN_VOTES points), best first."""
    return detect_lines(_points(Tables(spark, sf_dir)), "run_id", "x", "y")


@query(
    "summary_entries",
    oracle=f"""WITH {POINTS_SQL}, runs AS (SELECT DISTINCT run_id FROM pts), {lines_sql('pts', 'det')}
{entries_sql('det', C.SIDE_FRONT)}""",
)
def summary_entries_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#24: the summary map as long rows: line count per run (0 kept) and one
    ``THETA:..,R:..`` entry per line."""
    p = _points(Tables(spark, sf_dir))
    return summarize_runs(p, "run_id", "x", "y")


@query(
    "summary_side_filter",
    oracle=f"""WITH {POINTS_SQL}, runs AS (SELECT DISTINCT run_id FROM pts),
{lines_sql('pts', 'det_f', 'NOT is_back')}, {lines_sql('pts', 'det_b', 'is_back')},
e AS ({entries_sql('det_f', C.SIDE_FRONT)} UNION ALL {entries_sql('det_b', C.SIDE_BACK)})
SELECT * FROM e WHERE contains(qualifier, 'By') OR contains(qualifier, 'BNO_yES')""",
)
def summary_side_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#25: the entries of both passes, through the back-side writer's filter, which
    drops the front pass's (their qualifiers carry no ``B`` prefix)."""
    p = _points(Tables(spark, sf_dir))
    side = F.when(F.col("is_back"), F.lit(C.SIDE_BACK)).otherwise(F.lit(C.SIDE_FRONT))
    e = summarize_runs(p, "run_id", "x", "y", side, (C.SIDE_FRONT, C.SIDE_BACK))
    return e.where(side_writer_filter(F.col("qualifier"), C.SIDE_BACK))


@query(
    "pattern_table_entries",
    oracle=f"""WITH {POINTS_SQL}, runs AS (SELECT DISTINCT run_id FROM pts),
{lines_sql('pts', 'det_f', 'NOT is_back')}, {lines_sql('pts', 'det_b', 'is_back')},
e AS ({entries_sql('det_f', C.SIDE_FRONT)} UNION ALL {entries_sql('det_b', C.SIDE_BACK)}),
h AS (SELECT o_orderkey AS run_id, 'InspectionStationID' AS qualifier, o_orderpriority AS value FROM orders)
SELECT run_id, qualifier, value, qualifier IN ('NO_yES', 'BNO_yES') AS is_count FROM e
UNION ALL SELECT run_id, qualifier, value, false AS is_count FROM h""",
)
def pattern_table_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-13, SCL-10: what the pattern-table writer keeps of all entries of a run: each side's counts and
    lines, and the header entries it names; a count is a whole match of the qualifier."""
    t = Tables(spark, sf_dir)
    side = F.when(F.col("is_back"), F.lit(C.SIDE_BACK)).otherwise(F.lit(C.SIDE_FRONT))
    e = summarize_runs(_points(t), "run_id", "x", "y", side, (C.SIDE_FRONT, C.SIDE_BACK))
    head = t.orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.inline(F.array(*[F.struct(F.lit(n).alias("qualifier"), F.col(c).cast("string").alias("value")) for n, c in (("InspectionStationID", "o_orderpriority"), ("ConvertedTimestamp", "o_orderdate"))])),
    )
    q = F.col("qualifier")
    kept = e.where(pattern_table_filter(q, C.SIDE_FRONT) | pattern_table_filter(q, C.SIDE_BACK)).unionByName(head.where(info_keys_filter(q)))
    return kept.select("run_id", "qualifier", "value", (is_count_qualifier(q, C.SIDE_FRONT) | is_count_qualifier(q, C.SIDE_BACK)).alias("is_count"))


@query(
    "angle_match",
    oracle=f"""WITH p AS (SELECT p_partkey, p_size * {D(7.2)} AS rot FROM part),
s AS (SELECT s_suppkey, s_nationkey * {D(0.25)} AS theta FROM supplier)
SELECT rot, theta, count(DISTINCT p_partkey) AS n_parts, count(DISTINCT s_suppkey) AS n_suppliers FROM p JOIN s
  ON rot IS NOT NULL AND rot <= {D(C.FREE_ROTATION_ABOVE)}
 AND (abs(rot / {D(180)} * pi() - theta) < {D(C.ANGLE_MATCH_TOL)}
   OR abs((CASE WHEN rot >= {D(180)} THEN rot - {D(360)} ELSE rot END) / {D(180)} * pi() + pi() - theta)
      < {D(C.ANGLE_MATCH_TOL)})
GROUP BY rot, theta""",
)
def angle_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#26: JON-6 on its own: the rotations of parts and the angles of suppliers that agree,
    directly or opposite, within 0.01 rad, with the rows of each side. Both sides are
    counted per value first, so rows never pair with rows; then one bucketed band
    join on the angle over both directions of each rotation."""
    t = Tables(spark, sf_dir)
    tol = C.ANGLE_MATCH_TOL
    rot = F.col("rot")
    folded = F.when(rot >= 180.0, rot - 360.0).otherwise(rot)
    legs = F.array(
        F.struct(F.lit(1).alias("__leg"), (rot / 180.0 * pi()).alias("__a")),
        F.struct(F.lit(2).alias("__leg"), (folded / 180.0 * pi() + pi()).alias("__a")),
    )
    parts = (
        t.part.select("p_partkey", (F.col("p_size") * 7.2).alias("rot"))
        .where(rot.isNotNull() & (rot <= C.FREE_ROTATION_ABOVE))
        .groupBy("rot").agg(F.count(F.lit(1)).alias("n_parts"))
        .select("rot", "n_parts", F.inline(legs))
    )
    sup = t.supplier.groupBy((F.col("s_nationkey") * 0.25).alias("theta")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    sup = sup.where(F.col("theta").isNotNull())
    # one bucketed join over both directions; the opposite leg drops pairs the
    # direct leg already has, so each pair appears once
    leg_ok = (F.col("__leg") == 1) | ~angle_direct(F.col("rot"), F.col("theta"), tol)
    return band_join(parts, sup, "__a", "theta", tol, strict=True, residual=leg_ok).select(
        "rot", "theta", "n_parts", "n_suppliers"
    )


PROFILES_SQL = """p AS (SELECT CAST(r_regionkey AS INTEGER) AS profile, CAST(6 + 2 * r_regionkey AS INTEGER) AS angles,
  CAST(4 + r_regionkey AS DOUBLE) AS r_bin, 3 + r_regionkey % 2 AS least_votes, CAST(10 * (r_regionkey + 1) AS DOUBLE) AS off FROM region)"""


def profiles(spark: SparkSession, t: Tables) -> DataFrame:
    """SRC-6: the parameter sets, read back from their files."""
    return profile_table(read_properties(spark, model.parameter_files(spark, t, scratch_path(spark, "params"))))


@query(
    "config_profiles",
    oracle=f"""WITH {PROFILES_SQL},
m AS (SELECT p.profile, count(*) AS n FROM p, customer c, supplier s
      WHERE abs(s.s_acctbal - c.c_acctbal * {D(1000)} / {D(1000)}) <= p.off GROUP BY p.profile)
SELECT p.profile, p.off, coalesce(m.n, 0) AS n_matches FROM p LEFT JOIN m ON m.profile = p.profile""",
)
def config_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#10: detections run against each of the five parameter sets, read from their files: count
    of d1 matches within the set's tolerance. Each side is counted by bucket (half a tolerance
    wide) and value first: buckets up to one apart match whole, so their counts multiply;
    only buckets two and three apart, at the edge of the tolerance, compare values."""
    t = Tables(spark, sf_dir)
    sets = profiles(spark, t).select("profile", F.col("offset").alias("off"))
    table = sets.agg(F.collect_list(F.struct("profile", "off")).alias("a")).scalar()  # an entry a parameter set
    det = t.customer.groupBy(((F.col("c_acctbal") * 1000.0) / 1000.0).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    arm = t.supplier.groupBy(F.col("s_acctbal").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    det, arm = (x.select("v", "n", table.alias("__p")).select("v", "n", F.inline("__p")) for x in (det, arm))
    hits = band_counts(det, arm, "profile", "v", "n", "off")
    return (
        sets.select("profile", "off", F.lit(0).cast("bigint").alias("n_pairs"))
        .unionByName(hits.select("profile", "off", "n_pairs"))
        .groupBy("profile", "off")
        .agg(F.sum("n_pairs").cast("bigint").alias("n_matches"))
    )


@query(
    "profile_lines",
    oracle=f"""WITH {POINTS_SQL}, {PROFILES_SQL},
v AS (SELECT profile, run_id, least_votes, CAST(k AS INTEGER) AS theta_bin,
    CAST(floor(floor((x * cos(k * pi() / angles) + y * sin(k * pi() / angles)) * {D(1e6)} + {D(0.5)}) / (r_bin * {D(1e6)})) AS BIGINT) AS r_bin
  FROM pts, (SELECT *, unnest(range(angles)) AS k FROM p)),
g AS (SELECT profile, run_id, theta_bin, r_bin, count(*) AS votes FROM v
  GROUP BY profile, run_id, theta_bin, r_bin, least_votes HAVING count(*) >= least_votes)
SELECT profile, run_id, CAST(row_number() OVER (PARTITION BY profile, run_id ORDER BY votes DESC, theta_bin, r_bin) AS INTEGER) AS line_no,
  theta_bin, r_bin, votes FROM g""",
)
def profile_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6, JON-10: the lines of every run under each of the five parameter sets; the files
    decide the number of angles, the radius bin and the least votes."""
    t = Tables(spark, sf_dir)
    return profile_lines(_points(t), profiles(spark, t), "run_id", "x", "y")


_WRAP = C.THETA_BINS - 1


@query(
    "line_peaks",
    oracle=f"""WITH {POINTS_SQL}, {lines_sql('pts', 'det')},
near AS (SELECT d.run_id, d.theta_bin, d.r_bin, d.votes, a.dt, b.dr,
    (d.theta_bin + a.dt + {C.THETA_BINS}) % {C.THETA_BINS} AS t2,
    CASE WHEN d.theta_bin + a.dt BETWEEN 0 AND {_WRAP} THEN d.r_bin ELSE -d.r_bin - 1 END + b.dr AS r2
  FROM det d, (VALUES (-1), (0), (1)) a(dt), (VALUES (-1), (0), (1)) b(dr)),
beaten AS (SELECT DISTINCT n.run_id, n.theta_bin, n.r_bin FROM near n JOIN det o
  ON o.run_id = n.run_id AND o.theta_bin = n.t2 AND o.r_bin = n.r2
  WHERE (o.votes, -o.theta_bin, -o.r_bin) > (n.votes, -n.theta_bin, -n.r_bin))
SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY votes DESC, theta_bin, r_bin) AS INTEGER) AS peak_no,
  theta_bin, r_bin, votes
FROM det d WHERE NOT EXISTS (SELECT 1 FROM beaten b WHERE b.run_id = d.run_id AND b.theta_bin = d.theta_bin AND b.r_bin = d.r_bin)""",
)
def line_peaks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10: the peaks of every run's vote grid, one for each physical line."""
    return line_peaks(_points(Tables(spark, sf_dir)), "run_id", "x", "y")


@query(
    "consolidate_history",
    oracle=f"""WITH e AS (SELECT event_id, user_id, ts, value, event_id % 628 / {D(100)} AS theta FROM events)
SELECT a.event_id, count(b.event_id) AS n_similar,
  strftime(max(b.ts), '%Y-%m-%d %H:%M:%S.%f') AS last_similar
FROM e a LEFT JOIN e b
  ON b.user_id = a.user_id AND b.ts < a.ts AND b.ts >= a.ts - INTERVAL {C.HIST_DAYS} DAY
 AND abs(b.value - a.value) <= {D(C.CONSOLIDATE_VALUE_TOL)} AND abs(b.theta - a.theta) <= {D(C.ANGLE_TOLERANCE)}
GROUP BY a.event_id""",
)
def consolidate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#39 (JON-9): for each detection, the same entity's detections of the
    previous HIST_DAYS days within the radius and the angle tolerance: their count and
    the latest time; detections without any keep a 0 row."""
    e = Tables(spark, sf_dir).events
    det = e.select("event_id", "user_id", "ts", "value", ((F.col("event_id") % 628) / 100.0).alias("theta"))
    out = consolidate(det, ["event_id"], ["user_id"], "ts", "value", "theta")
    return out.withColumn("last_similar", F.date_format("last_similar", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_GROUP_DIMS = f"""SELECT event_id, user_id, event_id % 2 AS side, epoch_us(ts) AS t,
  CAST(floor(value * {D(1e6)} + {D(0.5)}) AS BIGINT) AS r, event_id % 628 AS a FROM events"""


@query(
    "consolidate_groups",
    oracle=f"""WITH RECURSIVE e AS ({_GROUP_DIMS}),
link AS (SELECT x.event_id AS i, y.event_id AS j FROM e x JOIN e y ON x.user_id = y.user_id AND x.side = y.side
  AND abs(x.t - y.t) <= {C.HIST_DAYS * 86_400_000_000} AND abs(x.r - y.r) <= {int(C.CONSOLIDATE_VALUE_TOL * 1e6)} AND abs(x.a - y.a) <= 30),
reach(i, j) AS (SELECT event_id, event_id FROM e UNION SELECT r.i, l.j FROM reach r JOIN link l ON l.i = r.j)
SELECT i AS event_id, min(j) AS group_id, count(*) AS group_size FROM reach GROUP BY i""",
)
def consolidate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-9 as groups: detections of one entity and side that are reachable over steps near in time,
    radius and angle; the group's id is its least detection."""
    e = Tables(spark, sf_dir).events
    det = e.select(
        "event_id", "user_id", (F.col("event_id") % 2).alias("side"), micros(F.col("ts")).alias("t"),
        round6(F.col("value")).cast("bigint").alias("r"), (F.col("event_id") % 628).alias("a"),
    )
    day = 86_400_000_000
    return near_groups(det, "event_id", ["user_id", "side"], [("t", C.HIST_DAYS * day), ("r", int(C.CONSOLIDATE_VALUE_TOL * 1e6)), ("a", 30)])


LEVELS = 4
_Z_SQL = "CAST(" + " + ".join(f"(((gx >> {i}) & 1) << {2 * i}) + (((gy >> {i}) & 1) << {2 * i + 1})" for i in range(16)) + " AS BIGINT)"


@query(
    "density_levels",
    oracle=f"""WITH {POINTS_SQL},
c AS (SELECT run_id, {bin_sql("x", C.FINE_X)} AS gx, {bin_sql("y", C.FINE_Y)} AS gy FROM pts),
l AS (SELECT run_id, CAST(k AS INTEGER) AS level, gx >> k AS gx, gy >> k AS gy FROM c, range({LEVELS}) t(k))
SELECT run_id, level, {_Z_SQL} AS cell,
  count(*) AS n_points
FROM l GROUP BY ALL""",
)
def density_levels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-11 at several resolutions: point counts per run in Z-order cells of four levels."""
    return density_levels(_points(Tables(spark, sf_dir)), "run_id", "x", "y", C.FINE_X, C.FINE_Y, LEVELS)


@query(
    "density_grid",
    oracle=f"""WITH {POINTS_SQL}
SELECT run_id, {bin_sql("x", C.GRID_X)} AS gx, {bin_sql("y", C.GRID_Y)} AS gy, count(*) AS n_points
FROM pts GROUP BY ALL""",
)
def density_grid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#40: point count per run and grid cell."""
    return density_grid(_points(Tables(spark, sf_dir)), "run_id", "x", "y")
