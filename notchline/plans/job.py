"""The reference's whole job as one Spark application over the stand-in model.

    python -m notchline.plans.job --sf /root/testdata/sf0.01 --out <dir> [--all-together]

Stages, each a DataFrame step planned by Catalyst (no per-file loop, no task
side effects):

1. parse: every file text once, into stored rows of header fields and listed points;
2. gates: parsed rows to device lookup to the first failing check per run,
   kept as a status table (rejects are rows with a reason, not exceptions), with the
   eligibility flag and side routing of the accepted runs;
3. sinks per device (or one shared table): header fields as long rows, points
   (keep-last, rendered), summary entries of the
   front and back writers, the pattern table (``y``) and the pattern rows of
   attributed detections; per-stage times and counts are taken during the writes.

Outputs are Parquet under ``--out``; with ``--all-together`` nothing is
partitioned by device (the reference's shared-table switch).
"""

from __future__ import annotations

import argparse
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.geometry import pi, rotate_grid
from notchline.operators.consolidate import consolidate
from notchline.operators.gates import eligibility_flag, point_side, station_tag, two_sided
from notchline.operators.history import asof_join
from notchline.operators.matching import band_match
from notchline.operators.patterns import (
    info_keys_filter,
    is_count_qualifier,
    pattern_table_filter,
    profile_table,
    side_writer_filter,
    summarize_runs,
)
from notchline.operators.sinks import last_put, retention_filter, upsert, write_partitioned
from notchline.plans import gate_queries as G
from notchline.plans import model
from notchline.plans.parsed import ParsedFiles
from notchline.plans.sink_queries import pattern_rows
from notchline.session import scratch_path
from notchline.sources import folders
from notchline.sources.lookups import read_properties
from notchline.sources.tables import Tables, require_inputs


def run_status(spark: SparkSession, t: Tables, parsed: ParsedFiles, maxpoint: int = C.MAXPOINT) -> DataFrame:
    """Per run, all of it from the parsed file: device, first failing gate, eligibility flag
    and review tag. One aggregate over the parsed rows, and the device lookup."""
    st = F.col("station")
    two = two_sided(st, G.TWO_SIDED)
    j = F.when(two, F.col("j_front")).otherwise(F.col("j_all"))
    return G.text_gates(spark, t, parsed.facts(), maxpoint).select(
        "o_orderkey",
        "device",
        "flat",
        "reason",
        eligibility_flag(st, j, G.SPECIAL, G.PRODUCTION, G.MAC).alias("flag"),
        station_tag(st, F.col("type"), G.TAG_ABSENT, G.TAG_PRESENT, C.TAG_TYPE).alias("tag"),
        two.alias("two_sided"),
    )


def header_rows(parsed: ParsedFiles, accepted: DataFrame) -> DataFrame:
    """SNK-2: every header field of each accepted run as a long row (rowkey = run id)."""
    runs = accepted.select("o_orderkey", "device")
    return parsed.fields().join(runs, "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("rowkey"), F.col("name").alias("qualifier"), "value", "device"
    )


def point_rows(parsed: ParsedFiles, accepted: DataFrame) -> DataFrame:
    """Points of accepted runs as their files list them, last line per (run, point id) wins. Front
    points carry their grid coordinates, turned by the run's flat position, as two more
    fields (PRJ-5)."""
    runs = accepted.select("o_orderkey", "device", "flat", "two_sided")
    pts = parsed.last_points().join(runs, "o_orderkey")
    front = point_side(F.col("two_sided"), model.flag_is_back(F.col("flag"))) == C.SIDE_FRONT
    gx, gy = rotate_grid(F.round("x").cast("int"), F.round("y").cast("int"), F.coalesce("flat", F.lit(0)))
    grid = [F.when(front, F.concat(F.lit(f"{name}:"), g.cast("string"))) for name, g in zip(C.GRID_FIELDS, (gx, gy), strict=True)]
    return pts.select(
        F.col("o_orderkey").cast("string").alias("rowkey"), F.col("name").alias("qualifier"), F.concat_ws(",", "value", *grid).alias("value"), "device"
    )


def summary_rows(parsed: ParsedFiles, analysed: DataFrame, detection: Row) -> DataFrame:
    """Front writer (all entries of the front pass) and back writer (back
    entries only) for the analysed runs; one-sided runs vote everything on the
    front and keep a zero back count. A run without points is still written
    (count 0 on both sides): it joins as one point-less row that only registers.
    One pass: the side is part of the vote key. ``detection``: the parameter set."""
    runs = analysed.select(F.col("o_orderkey").alias("run_id"), "two_sided", "device")
    p = runs.join(parsed.points(), "run_id", "left")
    side = point_side(F.col("two_sided"), F.col("is_back"))
    both = (C.SIDE_FRONT, C.SIDE_BACK)
    entries = summarize_runs(
        p, "run_id", "x", "y", side, both, F.col("x").isNotNull(), detection.angles, detection.r_bin, detection.least_votes
    )
    q = F.col("qualifier")
    # one pass: what the front writer keeps of the front entries, and the back writer of the back ones
    kept = entries.where(side_writer_filter(q, C.SIDE_BACK) | ~q.startswith(C.SIDE_BACK))
    return kept.join(runs.select("run_id", "device"), "run_id").select(
        F.col("run_id").cast("string").alias("rowkey"), "qualifier", "value", "device"
    )


def pattern_table(summary: DataFrame, header: DataFrame, analysed: DataFrame) -> DataFrame:
    """SNK-5 in long form, per analysed run: each side's count and detection
    entries (FLT-13), the device and station header entries, and each side's
    status cell after its puts -- ``1`` when the side has detections, then ``0``
    (the later put wins, Q11)."""
    sides = [C.SIDE_FRONT, C.SIDE_BACK]
    keep = F.lit(False)
    for side in sides:
        keep = keep | pattern_table_filter(F.col("qualifier"), side)
    entries = summary.where(keep)
    info = header.where(info_keys_filter(F.col("qualifier")))
    q = F.col("qualifier")
    counts = summary.where(is_count_qualifier(q, C.SIDE_FRONT) | is_count_qualifier(q, C.SIDE_BACK))
    status = counts.select(
        "rowkey",
        "device",
        F.concat(F.regexp_replace("qualifier", C.Q_COUNT + "$", ""), F.lit(C.Q_STATUS)).alias("qualifier"),
        last_put(
            F.array(
                F.struct(F.lit(1).alias("seq"), F.when(F.col("value") != "0", F.lit("1")).alias("value")),
                F.struct(F.lit(2).alias("seq"), F.lit("0").alias("value")),
            )
        ).alias("value"),
    )
    runs = analysed.select(F.col("o_orderkey").cast("string").alias("rowkey"))
    return entries.unionByName(info.join(runs, "rowkey", "left_semi")).unionByName(status)


def line_rows(summary: DataFrame, detection: Row) -> DataFrame:
    """(rowkey, side, k, r, theta) of the lines in the written summary table. Stand-in
    units: r is the bin's edge scaled to the arm unit (r_bin * width * 1000), theta the bin angle."""
    q, v = F.col("qualifier"), F.col("value")
    lines = summary.where(q.rlike(f"^B?{C.Q_DETECTION}[0-9]+$")).select(
        F.col("rowkey"),
        F.when(q.startswith(C.SIDE_BACK), F.lit(C.SIDE_BACK)).otherwise(F.lit(C.SIDE_FRONT)).alias("side"),
        F.regexp_extract(q, "([0-9]+)$", 1).cast("int").alias("k"),
        F.regexp_extract(v, C.T_THETA + "(-?[0-9]+)", 1).cast("int").alias("theta_bin"),
        F.regexp_extract(v, C.T_R + "(-?[0-9]+)", 1).cast("bigint").alias("r_bin"),
    )
    return lines.select(
        "rowkey", "side", "k",
        (F.col("r_bin") * detection.r_bin * 1000.0).alias("r"),
        (F.col("theta_bin") * pi() / float(detection.angles)).alias("theta"),
    )


def consolidated(t: Tables, summary: DataFrame, devices: DataFrame, detection: Row) -> DataFrame:
    """JON-9 per detected line: similar lines (radius within OFF arm units, angle within
    0.3) on the same side of earlier runs of the unit, at most HIST_DAYS back."""
    runs = t.orders.select(F.col("o_orderkey").cast("string").alias("rowkey"), "o_custkey", "o_orderdate")
    det = line_rows(summary, detection).join(runs, "rowkey")
    ids = ["rowkey", "side", "k"]
    out = consolidate(det.withColumn("on_side", F.col("side")), ids, ["o_custkey", "on_side"], "o_orderdate", "r", "theta", r_tol=detection.offset * C.R_UNIT_DIVISOR)
    return out.join(devices, "rowkey")


def detection_lists(t: Tables, summary: DataFrame, detection: Row) -> DataFrame:
    """Per detected line of an analysed run and side: the tools whose arm
    dimensions match the line (JON-5, side rule FLT-11) and that handled the
    run's unit at or before the run's own time (JON-4/JON-7), latest first, with
    their last times and areas (AGG-5). Lines come back from the written summary
    table; a line without such tools keeps empty lists. Pairs of a run and a tool exist
    only where the tool's arm fits one of the run's lines."""
    runs = t.orders.select(F.col("o_orderkey").cast("string").alias("rowkey"), "o_custkey", "o_orderdate")
    det = line_rows(summary, detection).join(runs, "rowkey")
    hist = model.history(t)
    # a line meets only the arms of its unit's tools that lie within its band; these pairs are then dated
    arms = model.arms(t).withColumnsRenamed({"side": "arm_side", "s_suppkey": "l_suppkey"})
    own = hist.select("o_custkey", "l_suppkey").distinct().join(arms, "l_suppkey")
    other = F.when(F.col("side") == C.SIDE_FRONT, F.lit(C.ARM_SIDE_BACK)).otherwise(F.lit(C.ARM_SIDE_FRONT))
    fits = band_match(det, own, detection.offset, keys=("o_custkey",)).where(F.col("arm_side").isNull() | (F.col("arm_side") != other))
    fits = fits.select("rowkey", "o_custkey", "o_orderdate", "side", "k", "l_suppkey", "tool", "area")
    held = asof_join(fits, hist, ["o_custkey", "l_suppkey"], "o_orderdate", "l_shipdate").where(F.col("n_asof") > 0)
    lst = F.sort_array(F.collect_list(F.struct("last_ts", "tool", "area")), asc=False)
    per_line = held.groupBy("rowkey", "side", "k").agg(lst.alias("__l"))

    def joined(f):
        return F.coalesce(F.array_join(F.transform("__l", f), ","), F.lit(""))

    full = det.select("rowkey", "side", "k").join(per_line, ["rowkey", "side", "k"], "left")
    return full.select(
        "rowkey", "side", "k",
        joined(lambda x: x["tool"]).alias("tool_list"),
        joined(lambda x: F.date_format(x["last_ts"], "yyyyMMdd")).alias("time_list"),
        joined(lambda x: x["area"]).alias("area_list"),
    )


def list_rows(lists: DataFrame, devices: DataFrame) -> DataFrame:
    """The per-detection lists as pattern-table rows: ``<side>domain_LIST<k>``,
    ``<side>TIMESTAMP_LIST<k>``, ``<side>AREA_LIST<k>``."""
    entries = F.array(*[
        F.struct(
            F.concat(F.col("side"), F.lit(name), F.col("k").cast("string")).alias("qualifier"),
            F.col(col).alias("value"),
        )
        for name, col in ((C.Q_TOOL_LIST, "tool_list"), (C.Q_TIME_LIST, "time_list"), (C.Q_AREA_LIST, "area_list"))
    ])
    return lists.select("rowkey", F.inline(entries)).join(devices, "rowkey")


class JobResult(dict):
    """Output paths by table name, plus ``metrics``: counts observed while the tables
    were written (no extra pass over the data): runs, accepted and analysed runs, and
    the rows of every table as ``<table>_rows``; and ``stages``, the path of the table of stage times."""

    metrics: dict
    stages: str


def parameter_set(spark: SparkSession, params: str | None, profile: int) -> Row:
    """SRC-6: one parameter set, a row, from the files in ``params``; the defaults without a folder."""
    if params is None:
        return Row(profile=profile, angles=C.THETA_BINS, r_bin=C.R_BIN, least_votes=C.MIN_VOTES, offset=C.OFF)
    found = profile_table(read_properties(spark, params)).where(F.col("profile") == profile).first()
    if found is None:
        raise LookupError(f"no parameter set {profile} in {params}")
    return found


INPUTS = ["orders", "customer", "lineitem", "supplier", "nation"]

#: What names a row of each table, for puts into tables of an earlier run.
ROW_KEYS = {
    "run_status": ["o_orderkey"],
    "image_info": ["rowkey", "qualifier"],
    "point_info": ["rowkey", "qualifier"],
    "image_summary": ["rowkey", "qualifier"],
    "y": ["rowkey", "qualifier"],
    "consolidated": ["rowkey", "side", "k"],
    "pattern": ["c_custkey"],
}
STAGES = "launch string, stage string, started timestamp, seconds double, n_rows long"


def run_job(
    spark: SparkSession,
    sf_dir: str,
    out_dir: str,
    all_together: bool = False,
    maxpoint: int = C.MAXPOINT,
    retain_days: int | None = None,
    put: bool = False,
    params: str | None = None,
    profile: int = 0,
) -> JobResult:
    """Write every sink. File texts are parsed once into a stored table that gates, header rows,
    points and detection read. Shared intermediates are not recomputed per output:
    each table is written once and later stages read the written table back,
    which also cuts the lineage (a lost executor costs a re-read, not a
    recomputation from the raw tables). With ``retain_days`` only runs no older than
    that before the newest run are accepted (SNK-8). A missing input table ends the
    job before any work (SRC-9).

    With ``put`` the rows are put into the tables that earlier launches wrote to ``out_dir``
    (SNK-6, SNK-7): a cell written again replaces the old one, only the touched devices'
    partitions are written again, and all else stays. Without it the tables are replaced.
    A later stage then reads this launch's own rows from the scratch folder, not the whole table.

    SRC-6: with ``params``, a folder of parameter files, set ``profile`` of it decides angle count, radius bin,
    least votes and band tolerance of the detection; without it the defaults hold.

    CTL-3: the time and the rows of every stage are appended to ``stage_metrics``."""
    require_inputs(spark, sf_dir, INPUTS)
    t = Tables(spark, sf_dir)
    by = None if all_together else "device"
    result = JobResult()
    result.metrics = {}
    root = out_dir.rstrip("/")
    times: list[tuple] = []
    launch = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%f")
    own = scratch_path(spark, "job")

    def timed(stage: str, work, n_rows=lambda: None):
        started, clock = datetime.now(timezone.utc), time.monotonic()
        out = work()
        times.append((launch, stage, started, time.monotonic() - clock, n_rows()))
        return out

    def write(name: str, df: DataFrame, *counts: F.Column) -> DataFrame:
        path = f"{root}/{name}"
        seen = Observation(name)
        rows = df.observe(seen, F.count(F.lit(1)).alias(f"{name}_rows"), *counts)

        def work() -> DataFrame:
            if not put:
                write_partitioned(rows, path, by, mode="overwrite")
                return spark.read.schema(df.schema).parquet(path)
            write_partitioned(rows, f"{own}/{name}", by)
            mine = spark.read.schema(df.schema).parquet(f"{own}/{name}")
            upsert(mine, path, ROW_KEYS[name], by)
            return mine

        back = timed(name, work, lambda: seen.get[f"{name}_rows"])
        result[name] = path
        result.metrics |= seen.get
        return back

    detection = parameter_set(spark, params, profile)
    parsed = timed("parse", lambda: ParsedFiles(spark, t, f"{own}/parsed"))
    clean = F.col("reason").isNull()
    status = write(
        "run_status",
        run_status(spark, t, parsed, maxpoint),
        F.count(F.lit(1)).alias("runs"),
        F.count(F.when(clean, F.lit(1))).alias("accepted"),
        F.count(F.when(clean & F.col("flag"), F.lit(1))).alias("analysed"),
    )
    accepted = status.where(clean)
    if retain_days is not None:
        young = retention_filter(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", retain_days)
        accepted = accepted.join(young.select("o_orderkey"), "o_orderkey", "left_semi")
    analysed = accepted.where(F.col("flag"))
    header = write("image_info", header_rows(parsed, accepted))
    write("point_info", point_rows(parsed, accepted))
    summary = write("image_summary", summary_rows(parsed, analysed, detection))
    devices = analysed.select(F.col("o_orderkey").cast("string").alias("rowkey"), "device")
    lists = list_rows(detection_lists(t, summary, detection), devices)
    write("y", pattern_table(summary, header, analysed).unionByName(lists))
    write("consolidated", consolidated(t, summary, devices, detection))
    # pattern rows of the units with an analysed run, as of the latest of these
    analysed_runs = t.orders.join(analysed.select("o_orderkey", "device"), "o_orderkey")
    write("pattern", pattern_rows(t, model.latest_runs(analysed_runs), "inner"))
    result.stages = f"{root}/stage_metrics"
    spark.createDataFrame(times, STAGES).coalesce(1).write.mode("append").parquet(result.stages)  # a row a stage
    folders.delete(spark, own)
    return result


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--sf", required=True, help="directory of the input tables")
    ap.add_argument("--out", required=True, help="output directory (shared storage on a cluster)")
    ap.add_argument("--maxpoint", type=int, default=C.MAXPOINT, help="most points of an accepted run")
    ap.add_argument("--retain-days", type=int, help="accept only runs this young, counted from the newest")
    ap.add_argument("--params", help="folder of parameter files")
    ap.add_argument("--profile", type=int, default=0, help="the parameter set of these that detection uses")
    ap.add_argument("--put", action="store_true", help="put into the tables of earlier launches instead of replacing them")
    ap.add_argument("--all-together", action="store_true", help="one shared table instead of one per device")
    args = ap.parse_args(argv)
    from notchline.session import build_session

    spark = build_session(app="notchline-job")  # the launcher's settings win
    result = run_job(spark, args.sf, args.out, args.all_together, args.maxpoint, args.retain_days, args.put, args.params, args.profile)
    for name, path in result.items():
        print(name, path)
    print("metrics", result.metrics)
    print("stages", result.stages)


if __name__ == "__main__":
    main()
