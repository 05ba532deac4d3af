"""Shared fragments of the DuckDB SQL twins of the keyed queries.

Written in the direct (textbook) form -- nested-loop band predicates, correlated
ranges, ``row_number`` -- so each one checks the Spark plan's rewrites rather
than repeating them. Doubles are computed with the same operation order as the
Spark expressions; literals are cast to DOUBLE so no decimal arithmetic sneaks in.
"""

from __future__ import annotations

from notchline import constants as C

D = "CAST({} AS DOUBLE)".format

# ---- model fragments -------------------------------------------------------

DET = f"""det AS (
  SELECT c_custkey, c_acctbal * {D(1000)} AS r, c_nationkey * {D(0.25)} AS theta FROM customer)"""

ARM = f"""arm AS (
  SELECT s_suppkey, s_name AS tool, n_name AS area, s_acctbal AS d1, s_acctbal / {D(2)} AS d2,
         CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE s_nationkey * {D(14.4)} END AS rot,
         CASE s_suppkey % 3 WHEN 0 THEN 'FRONT' WHEN 1 THEN 'BACK' ELSE NULL END AS side
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""


ARM_REFERENCE = f"""arm AS (
  SELECT n_nationkey, n_nationkey * {D(400)} - {D(500)} AS d1, (n_nationkey * {D(400)} - {D(500)}) / {D(2)} AS d2,
         CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey * {D(14.4)} END AS rot FROM nation)"""


def angle_ok(rot: str, theta: str, tol: float = C.ANG) -> str:
    return (
        f"({rot} IS NULL OR {rot} > {D(C.FREE_ROTATION_ABOVE)}"
        f" OR abs({rot} / {D(180)} * pi() - {theta}) < {D(tol)}"
        f" OR abs((CASE WHEN {rot} >= {D(180)} THEN {rot} - {D(360)} ELSE {rot} END)"
        f" / {D(180)} * pi() + pi() - {theta}) < {D(tol)})"
    )


def band_cond(det: str = "d", arm: str = "a", off: str | None = None) -> str:
    off = off or D(C.OFF)
    v = f"{det}.r / {D(1000)}"
    return (
        f"(abs({arm}.d1 - {v}) <= {off} OR (abs({arm}.d2 - {v}) <= {off}"
        f" AND {angle_ok(f'{arm}.rot', f'{det}.theta')}))"
    )


# the unit's own run time: its latest run
RUNS = """runs AS (
  SELECT o_custkey, o_orderdate AS run_ts, o_orderpriority AS station FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""

HIST_LATEST = f"""{RUNS},
hist AS (
  SELECT o.o_custkey, l_suppkey, max(l_shipdate) AS last_ts
  FROM lineitem JOIN orders o ON l_orderkey = o_orderkey JOIN runs u ON u.o_custkey = o.o_custkey
  WHERE l_shipdate <= run_ts
  GROUP BY o.o_custkey, l_suppkey)"""

ATTR = f"""attr AS (
  SELECT d.c_custkey, a.s_suppkey, a.tool, a.area, h.last_ts
  FROM det d JOIN arm a ON {band_cond()}
  JOIN hist h ON h.o_custkey = d.c_custkey AND h.l_suppkey = a.s_suppkey)"""

# ---- rendered lookup files and history tables --------------------------------

ARM_LINES = f"""arm_lines AS (
  SELECT CAST(s_suppkey AS VARCHAR) || ',' || n_name || ',R' || CAST(n_regionkey AS VARCHAR) || ',M,' ||
    s_name || ',,,,' ||
    CASE WHEN s_suppkey % 7 = 0 THEN 'x' ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END || ',' ||
    CAST(CAST(s_acctbal / {D(2)} AS DECIMAL(18,3)) AS VARCHAR) || ',,,' ||
    CASE WHEN s_nationkey % 5 = 0 THEN 'NO'
         ELSE 'YES ' || CAST(CAST(s_nationkey * {D(14.4)} AS DECIMAL(10,1)) AS VARCHAR) || 'deg' END || ',' ||
    CASE s_suppkey % 3 WHEN 0 THEN 'FRONT' WHEN 1 THEN 'BACK' ELSE '' END AS value
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT '#,' || n_name || ',' || CAST(n_regionkey AS VARCHAR) AS value FROM nation)"""

ARM_PARSED = f"""arm_split AS (
  SELECT string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM arm_lines),
arm_parsed AS (
  SELECT f[1] AS arm_key, f[2] AS area, f[5] AS tool,
    CASE WHEN length(f[9]) > 0 THEN TRY_CAST(f[9] AS DOUBLE) END AS d1,
    CASE WHEN length(f[10]) > 0 THEN TRY_CAST(f[10] AS DOUBLE) END AS d2,
    CASE WHEN contains(f[13], 'YES') AND len(string_split(f[13], ' ')) > 1
         THEN CASE WHEN length(replace(trim(string_split(f[13], ' ')[2]), 'deg', '')) > 0
                   THEN TRY_CAST(replace(trim(string_split(f[13], ' ')[2]), 'deg', '') AS DOUBLE) END END AS rot,
    CASE WHEN f[14] IN ('FRONT', 'BACK') THEN f[14] END AS side
  FROM arm_split WHERE len(f) >= 5)"""

DEVICE_LINES = """device_lines AS (
  SELECT n_nationkey AS line_key, n_regionkey AS line_group,
    CAST(n_nationkey AS VARCHAR) || ',' || n_name || ',' || CAST(n_regionkey AS VARCHAR) || ',R' ||
    CAST(n_regionkey AS VARCHAR) || ',' || CAST(n_nationkey % 4 * 90 AS VARCHAR) AS line
  FROM nation)"""

HIST_INDEX = """hidx AS (
  SELECT c_name || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS index_key,
         strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

HIST_ROWS = """hrows AS (
  SELECT strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS rowkey,
         'run,' || o_orderpriority || ',' || o_orderstatus AS rundata
  FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))"""
