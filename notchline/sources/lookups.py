"""Positional lookup files: the arm dimension CSV, the device reference CSV and
the indexed parameter sets.

These files are read as text lines and split with the reference's positional
rules, so a short or malformed line becomes nulls (or is dropped) instead of an
error. They are read once per job, not once per inspected file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.text import field, java_split, java_trim


def _number(text: Column) -> Column:
    """Parse a decimal number; null for empty or unparsable text."""
    return F.when(F.length(text) > 0, text.try_cast("double"))


def parse_arm_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """SRC-5 + FLT-11: one arm row per line with at least 5 fields.

    Output: ``arm_key`` (field 0), ``area``, ``tool``, ``d1``, ``d2`` (null when
    absent or bad; the reference's -999999.0), ``rot`` (degrees from
    ``YES <n>deg``; null otherwise, the reference's 9999.0) and ``side``
    (``FRONT`` / ``BACK`` / null).
    """
    f = java_split(F.col(text_col), ",")
    fs = F.col("__f")
    side = field(fs, C.ARM_SIDE_FIELD)
    return (
        lines.select(f.alias("__f"))
        .where(F.size("__f") >= C.ARM_MIN_FIELDS)
        .select(
            field(fs, 0).alias("arm_key"),
            field(fs, C.ARM_AREA_FIELD).alias("area"),
            field(fs, C.ARM_TOOL_FIELD).alias("tool"),
            _number(field(fs, C.ARM_D1_FIELD)).alias("d1"),
            _number(field(fs, C.ARM_D2_FIELD)).alias("d2"),
            _rot_from(fs).alias("rot"),
            F.when(side.isin(C.ARM_SIDE_FRONT, C.ARM_SIDE_BACK), side).alias("side"),
        )
    )


def _rot_from(f: Column) -> Column:
    rot_text = field(f, C.ARM_ROT_FIELD)
    rot_parts = F.split(rot_text, " ")
    value = F.replace(java_trim(F.get(rot_parts, 1)), F.lit(C.ARM_ROT_UNIT), F.lit(""))
    return F.when(
        rot_text.contains(C.ARM_ROT_FLAG) & (F.size(rot_parts) > 1), _number(value)
    )


def side_eligible(side: Column, pass_side: str) -> Column:
    """FLT-11 side rule: the front pass skips BACK arms, the back pass skips FRONT
    arms, an arm without a side serves both."""
    other = C.ARM_SIDE_BACK if pass_side == C.SIDE_FRONT else C.ARM_SIDE_FRONT
    return side.isNull() | (side != other)


def with_sentinels(arms: DataFrame) -> DataFrame:
    """Render absent numbers as the reference's sentinels."""
    return arms.withColumns(
        {
            "d1": F.coalesce("d1", F.lit(C.MISSING_DIMENSION)),
            "d2": F.coalesce("d2", F.lit(C.MISSING_DIMENSION)),
            "rot": F.coalesce("rot", F.lit(C.NO_ROTATION)),
        }
    )


def read_arm_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_arm_lines(spark.read.text(path))


def parse_device_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """SRC-4: device reference lines with the flat position parsed from field 4
    (null when absent or not an integer)."""
    f = java_split(F.col(text_col), ",")
    return lines.withColumn(
        "flat", field(f, C.DEVICE_FLAT_FIELD).try_cast("int")
    )


def read_properties(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """SRC-6: ``key=value`` parameter files ``...<i>.properties`` read in one scan
    -> ``(profile, key, value)``, the profile index taken from the file name.
    Comment and blank lines are skipped."""
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    kv = F.split(F.col("value"), "=", 2)
    line = java_trim(F.col("value"))
    return raw.where(
        (F.length(line) > 0) & ~line.startswith("#") & ~line.startswith("!")
    ).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.properties$", 1)
        .cast("int")
        .alias("profile"),
        java_trim(F.get(kv, 0)).alias("key"),
        java_trim(F.get(kv, 1)).alias("value"),
    )
