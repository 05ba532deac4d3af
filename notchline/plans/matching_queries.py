
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.operators.matching import attribute, band_match, latest_per_tool
from notchline.plans import model
from notchline.plans import oracle as O
from notchline.plans.registry import query
from notchline.sources.tables import Tables


@query(
    "band_match",
    oracle=f"""WITH {O.DET}, {O.ARM_REFERENCE}
SELECT d.c_custkey, a.n_nationkey FROM det d JOIN arm a ON {O.band_cond()}""",
)
def band_match_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#27: detections x the arm reference under JON-5, bucketed (no nested-loop join).
    The reference has a fixed number of rows, so the pairs grow with the detections.
    Each arm enters once per leg (d1, d2) and is repeated into 3 buckets; detections keep their own."""
    t = Tables(spark, sf_dir)
    return band_match(model.detections(t), model.arm_reference(t), C.OFF, repeat="right").select("c_custkey", "n_nationkey")


def attribution(t: Tables, runs: DataFrame) -> DataFrame:
    """Detections with the tools that fit them and handled the unit up to the unit's own
    run time (``runs``: one per unit, with ``run_ts``)."""
    held = latest_per_tool(model.history(t), runs, "o_custkey", "l_suppkey", "l_shipdate").withColumnsRenamed(
        {"o_custkey": "c_custkey", "l_suppkey": "s_suppkey"}
    )
    arm = model.arms(t).select("s_suppkey", "tool", "area", "d1", "d2", "rot")
    return attribute(model.detections(t), arm, held, ["c_custkey"], "s_suppkey").select(
        "c_custkey", "s_suppkey", "tool", "area", "last_ts"
    )


@query(
    "tool_attribution",
    oracle=f"""WITH {O.DET}, {O.ARM}, {O.HIST_LATEST}, {O.ATTR}
SELECT c_custkey, s_suppkey, tool, area, strftime(last_ts, '%Y%m%d') AS last_time FROM attr""",
)
def tool_attribution_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#30 (flagship): detections matched to the arms of the tools that handled the
    unit up to its latest run, with the tool's latest time and its area."""
    t = Tables(spark, sf_dir)
    return attribution(t, model.latest_runs(t.orders)).select(
        "c_custkey",
        "s_suppkey",
        "tool",
        "area",
        F.date_format("last_ts", "yyyyMMdd").alias("last_time"),
    )
