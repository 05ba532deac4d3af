"""Folders of tables, by Hadoop's file system: any store that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: The directory name that Spark gives to a null partition value (fixed).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _open(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _open(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; empty when there is none."""
    p, fs = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's outermost partition column, from its directories."""
    start = f"{column}="
    return [n[len(start):] for n in names(spark, path) if n.startswith(start)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file (a parameter file, a marker)."""
    p, fs = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
