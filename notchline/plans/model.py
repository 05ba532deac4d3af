"""

files       = documents / pages
runs        = orders joined to customer (station text = o_orderpriority)
points      = lineitem (run l_orderkey, id l_linenumber, x l_quantity,
              y l_discount*100, class R -1 / A 1 / N 0, back side when l_linestatus = 'O')
history     = lineitem joined to orders (unit o_custkey, tool l_suppkey, time l_shipdate)
arms        = supplier joined to nation (tool s_name, area n_name)
detections  = customer (r = c_acctbal*1000, theta = c_nationkey*0.25)

Each builder returns a lazy DataFrame; nothing is read until an action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.sources import folders
from notchline.sources.tables import Tables


def detections(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        (F.col("c_acctbal") * 1000.0).alias("r"),
        (F.col("c_nationkey") * 0.25).alias("theta"),
    )


def arms(t: Tables) -> DataFrame:
    """One arm row per supplier: d1 = balance, d2 = half of it, rotation from the
    nation key (none for every fifth), side by key modulo 3 (FRONT, BACK, unset)."""
    s = t.supplier
    n = t.nation.select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        "s_suppkey",
        F.col("s_name").alias("tool"),
        F.col("n_name").alias("area"),
        F.col("s_acctbal").alias("d1"),
        (F.col("s_acctbal") / 2.0).alias("d2"),
        F.when(F.col("s_nationkey") % 5 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("s_nationkey") * 14.4)
        .alias("rot"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit(C.ARM_SIDE_FRONT))
        .when(F.col("s_suppkey") % 3 == 1, F.lit(C.ARM_SIDE_BACK))
        .otherwise(F.lit(None).cast("string"))
        .alias("side"),
    )


def arm_reference(t: Tables) -> DataFrame:
    """The arm dimensions as the reference has them: a list of fixed length (one row per
    nation), against which any number of detections is matched."""
    k = F.col("n_nationkey")
    d1 = k * 400.0 - 500.0
    return t.nation.select(
        "n_nationkey",
        d1.alias("d1"),
        (d1 / 2.0).alias("d2"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(k * 14.4).alias("rot"),
    )


def history(t: Tables) -> DataFrame:
    """(unit, tool, time) rows: which tool handled which unit when."""
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey"), F.col("l_suppkey"), F.col("l_shipdate")
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """(unit, run time, station) of each unit's latest run; ``runs`` are order rows. A column
    ``device`` of theirs comes along."""
    more = ["device"] if "device" in runs.columns else []
    last = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority", *more)).alias("last")
    return runs.groupBy("o_custkey").agg(last).select(
        "o_custkey",
        F.col("last.o_orderdate").alias("run_ts"),
        F.col("last.o_orderpriority").alias("station"),
        *[F.col(f"last.{c}").alias(c) for c in more],
    )


def point_class() -> F.Column:
    return (
        F.when(F.col("l_returnflag") == "R", F.lit(-1))
        .when(F.col("l_returnflag") == "A", F.lit(1))
        .otherwise(F.lit(0))
    )


def points(t: Tables) -> DataFrame:
    """One row per point with its run, id, coordinates, class and side flag."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("run_id"),
        F.col("l_linenumber").alias("point_id"),
        F.col("l_quantity").alias("x"),
        (F.col("l_discount") * 100.0).alias("y"),
        point_class().alias("class_no"),
        (F.col("l_linestatus") == "O").alias("is_back"),
    )


# ---- lookup files and history tables rendered from the stand-in tables -------


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def arm_csv_lines(t: Tables) -> DataFrame:
    """The arm dimension CSV as text lines: one 14-field line per supplier
    (d1 text ``x`` on every 7th to exercise the fallback, rotation ``YES <n>deg``
    or ``NO``, side ``FRONT`` / ``BACK`` / empty, which Java-style splitting
    drops) plus a 3-field section line per nation, which the parser skips."""
    s = t.supplier
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    sn = s.join(n, s.s_nationkey == n.n_nationkey)
    d1 = F.when(F.col("s_suppkey") % 7 == 0, F.lit("x")).otherwise(
        _s(F.col("s_acctbal").cast("decimal(18,2)"))
    )
    d2 = _s((F.col("s_acctbal") / 2.0).cast("decimal(18,3)"))
    rot = F.when(F.col("s_nationkey") % 5 == 0, F.lit("NO")).otherwise(
        F.concat(F.lit("YES "), _s((F.col("s_nationkey") * 14.4).cast("decimal(10,1)")), F.lit("deg"))
    )
    side = (
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("FRONT"))
        .when(F.col("s_suppkey") % 3 == 1, F.lit("BACK"))
        .otherwise(F.lit(""))
    )
    arm_lines = sn.select(
        F.concat_ws(
            ",",
            _s("s_suppkey"), F.col("n_name"), F.concat(F.lit("R"), _s("n_regionkey")), F.lit("M"),
            F.col("s_name"), F.lit(""), F.lit(""), F.lit(""), d1, d2, F.lit(""), F.lit(""), rot, side,
        ).alias("value")
    )
    section_lines = n.select(
        F.concat_ws(",", F.lit("#"), F.col("n_name"), _s("n_regionkey")).alias("value")
    )
    return arm_lines.unionByName(section_lines)


def device_lines(t: Tables) -> DataFrame:
    """The device reference CSV: one line per nation,
    ``key,name,region,R<region>,<flat>`` with flat = (key % 4) * 90, kept in file
    order (region, key) so a name can be found inside an earlier line first."""
    n = t.nation
    return n.select(
        F.col("n_nationkey").alias("line_key"),
        F.col("n_regionkey").alias("line_group"),
        F.concat_ws(
            ",",
            _s("n_nationkey"), F.col("n_name"), _s("n_regionkey"),
            F.concat(F.lit("R"), _s("n_regionkey")), _s((F.col("n_nationkey") % 4) * 90),
        ).alias("line"),
    )


POINT_COLUMNS = ("ID", "PART", "SUPP", "FLAG", "X", "Y")


def point_texts(t: Tables) -> DataFrame:
    """``(l_orderkey, n, points)``: every run's point list as the lines of its file, in the order of
    (time, part, supplier, id). Coordinates are in thousandths for runs of the newer dialect, in
    units for the others. One value a run, as a file's text is: bounded by the file."""
    scale = F.when(F.col("l_orderkey") % 2 == 0, F.lit(C.SCALE_NEW)).otherwise(F.lit(C.SCALE_OLD))

    def number(v: Column) -> Column:
        return _s((v.cast("decimal(20,6)") / scale).cast("decimal(20,6)"))

    line = F.concat_ws(
        " ",
        _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"), F.concat("l_returnflag", "l_linestatus"),
        number(F.col("l_quantity")), number(F.col("l_discount") * 100.0),
    )
    entry = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", line.alias("line"))
    per_run = t.lineitem.select("l_orderkey", entry.alias("e")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("e")).alias("l"))
    return per_run.select("l_orderkey", F.size("l").alias("n"), F.array_join(F.col("l.line"), "\n").alias("points"))


def file_texts(t: Tables) -> DataFrame:
    """Every run's file, ``(o_orderkey, text)``: dialect by key parity, the
    device (nation name; none for the BUILDING segment, a name the device reference
    lacks for every fifth nation), a 12-character image id (shorter for keys under
    100), maker / type / station on one line, the fields that the first gates test, the
    run's time; then a list of one count and the list of the run's points."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    r = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
    r = r.join(point_texts(t), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key, pr = F.col("o_orderkey"), F.col("o_orderpriority")

    def line(name: str, *values: Column, when: Column | None = None) -> Column:
        quoted = F.concat_ws(", ", *[F.concat(F.lit('"'), v, F.lit('"')) for v in values])
        text = F.concat(F.lit(f"Field {name} {len(values)} {{"), quoted, F.lit("}"))
        return text if when is None else F.when(when, text)

    device = F.when(F.col("c_nationkey") % 5 == 4, F.concat(F.lit("UNLISTED-"), _s("c_nationkey"))).otherwise(F.col("n_name"))
    return r.select(
        "o_orderkey",
        F.concat_ws(
            "\n",
            F.when(key % 2 == 0, F.lit(C.DIALECT_MARKER)).otherwise(F.lit("FileVersion 1 7;")),
            line("DeviceID", device, when=F.coalesce(F.col("c_mktsegment") != "BUILDING", F.lit(False)) & device.isNotNull()),
            line("imageID", F.when(key < 100, _s("o_orderkey")).otherwise(F.lpad(_s("o_orderkey"), C.IMAGE_ID_LENGTH, "0"))),
            line(C.STATION_FIELD, F.lit("MAKER"), F.when(pr == "4-NOT SPECIFIED", F.lit(C.EXCLUDED_TYPE)).otherwise(F.lit("SCAN")), pr),
            line("DiePitchX", F.when(key % 97 == 0, F.lit(C.EXCLUDED_PITCH)).otherwise(F.lit("1000"))),
            line("domainarge", F.lit(C.PLACEHOLDER_VALUE), when=pr == "5-LOW"),
            line("ConvertedTimestamp", F.date_format("o_orderdate", "yyyyMMdd")),
            F.lit("List SummaryList 2 { KIND COUNT }"),
            F.concat(F.lit("points "), _s(F.coalesce("n", F.lit(0)))),
            F.lit(C.END_OF_LIST),
            F.lit(f"List {C.POINT_LIST} {len(POINT_COLUMNS)} {{ {' '.join(POINT_COLUMNS)} }}"),
            F.col("points"),
            F.lit(C.END_OF_LIST),
        ).alias("text"),
    )


def flag_class(flag: Column) -> Column:
    """Class number of a point's flag text: R -1, A 1, else 0."""
    return F.when(flag.startswith("R"), F.lit(-1)).when(flag.startswith("A"), F.lit(1)).otherwise(F.lit(0))


def flag_is_back(flag: Column) -> Column:
    return F.coalesce(flag.endswith("O"), F.lit(False))


def parameter_files(spark: SparkSession, t: Tables, folder: str) -> str:
    """The parameter sets as files ``ParamConfig<i>.properties`` in ``folder``, one for each region
    (the reference has five): angle count, radius bin, least votes and band tolerance."""
    for r in t.region.select("r_regionkey", "r_name").collect():  # one small file each
        k = r.r_regionkey
        lines = [f"# {r.r_name}", f"angles={6 + 2 * k}", f"r_bin = {4.0 + k}", "", f"least_votes={3 + k % 2}", f"offset={10.0 * (k + 1)}"]
        folders.write_text(spark, f"{folder}/ParamConfig{k}.properties", "\n".join(lines) + "\n")
    return folder


def history_index(t: Tables) -> DataFrame:
    """History index rows: key ``<c_name>_<yyyymmdd>_<orderkey>``, value = the
    history rowkey ``<yyyymmdd>_<orderkey>``."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey", "c_name")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    rowkey = F.concat_ws("_", day, _s("o_orderkey"))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.concat_ws("_", F.col("c_name"), rowkey).alias("index_key"),
        rowkey.alias("value"),
    )


def history_rows(t: Tables) -> DataFrame:
    """History rows ``(rowkey, rundata)`` with ``rundata = run,<tool>,<station>``,
    present only for runs that have points (others are missing, as in a store
    where the index outlives the row)."""
    o = t.orders
    li = t.lineitem.select("l_orderkey")
    kept = o.join(li, o.o_orderkey == li.l_orderkey, "left_semi")
    return kept.select(
        F.concat_ws("_", F.date_format("o_orderdate", "yyyyMMdd"), _s("o_orderkey")).alias("rowkey"),
        F.concat_ws(",", F.lit("run"), F.col("o_orderpriority"), F.col("o_orderstatus")).alias("rundata"),
    )
