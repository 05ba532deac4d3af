"""Matching detections to equipment (arm) dimensions and attributing them to the
equipment in the unit's history.

Inputs, as DataFrames:
  detections: ``det_cols...``, ``r`` (double, in 1/1000 of the arm unit), ``theta`` (radians)
  arms:       ``arm_cols...``, ``d1``, ``d2`` (doubles, null when absent), ``rot`` (degrees or null)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.geometry import angle_ok
from notchline.operators.band_join import band_join
from notchline.operators.groups import within_groups

STEPS = 4  # a history row is held by so many steps of a task at once: sorts and aggregates


def band_match(
    detections: DataFrame,
    arms: DataFrame,
    off: float | str = C.OFF,
    *,
    keys: tuple[str, ...] = (),
    repeat: str = "right",
) -> DataFrame:
    """JON-5: pairs with ``|d1 - r/1000| <= off`` or
    (``|d2 - r/1000| <= off`` and the angle test) -- ``and`` binding tighter, so a
    d1 match needs no angle.

    Planned as one bucketed equi-join: each arm enters twice, tagged with the
    value of its leg (d1 or d2), and the residual applies the leg's own test; the
    d2 leg drops pairs the d1 leg already has, so no pair appears twice and no
    distinct is needed. One scan of each input, no nested-loop join. ``off`` may
    name a key column carrying a per-key tolerance (parameter profiles).
    """
    det = detections.withColumn("__v", F.col("r") / C.R_UNIT_DIVISOR)
    legs = F.array(
        F.struct(F.lit(1).alias("__leg"), F.col("d1").alias("__w")),
        F.struct(F.lit(2).alias("__leg"), F.col("d2").alias("__w")),
    )
    tagged = arms.select("*", F.inline(legs))
    tol = F.col(off) if isinstance(off, str) else F.lit(float(off))
    d1_hit = F.coalesce(F.abs(F.col("d1") - F.col("__v")) <= tol, F.lit(False))
    leg_ok = (F.col("__leg") == 1) | (angle_ok(F.col("rot"), F.col("theta")) & ~d1_hit)
    out = band_join(det, tagged, "__v", "__w", off, keys=keys, repeat=repeat, residual=leg_ok)
    return out.drop("__v", "__w", "__leg")


def within_band(off: float = C.OFF) -> F.Column:
    """JON-5 as a test of one pair: columns ``r``, ``theta`` and ``d1``, ``d2``, ``rot``."""
    v = F.col("r") / C.R_UNIT_DIVISOR
    by_d2 = (F.abs(F.col("d2") - v) <= off) & angle_ok(F.col("rot"), F.col("theta"))
    return F.coalesce(F.abs(F.col("d1") - v) <= off, F.lit(False)) | F.coalesce(by_d2, F.lit(False))


def latest_per_tool(history: DataFrame, runs: DataFrame, unit: str, tool: str, ts: str) -> DataFrame:
    """History of each unit up to the unit's own run time (``runs``: unit, ``run_ts``),
    reduced to one row per (unit, tool) with its latest time. Units are dealt into tasks of
    bounded size, where the join, the aggregate and what follows by unit take place; the
    history of a larger unit is shuffled by (unit, tool), after partial aggregation, and does
    not land whole in one task."""
    own = runs.select(unit, "run_ts")

    def work(h: DataFrame) -> DataFrame:
        return h.join(own, unit).where(F.col(ts) <= F.col("run_ts")).groupBy(unit, tool).agg(F.max(ts).alias("last_ts"))

    return within_groups(history.select(unit, tool, ts), unit, work, STEPS)


def attribute(detections: DataFrame, arms: DataFrame, held: DataFrame, on: list[str], tool: str, off: float = C.OFF) -> DataFrame:
    """JON-7, history first: detections meet the tools of their own history (``held``, by
    ``on``), these their arm rows (by ``tool``), and the band and angle tests of JON-5
    are a filter. No pair exists that is not a history row, so the work grows with
    the history. Tool identity is equality, not substring."""
    return detections.join(held, on).join(arms, tool).where(within_band(off))
