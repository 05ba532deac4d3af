"""Parquet table loader for the stand-in tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table. Column pruning and filter pushdown reach the scan through
    Catalyst, so callers select only what they use and nothing is read eagerly."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one scale directory: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self._spark, self._dir, name)


def require_tables(spark: SparkSession, names: list[str]) -> None:
    """SRC-9: a job-level guard -- fail fast, before any work, when a catalog table
    the job reads (e.g. the history index and rows) does not exist. The reference
    checks this per file and skips the file; the answer is the same for every
    file of a launch, so it is checked once."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise LookupError(f"required tables missing: {', '.join(missing)}")


def missing_reason(spark: SparkSession, sf_dir: str, names: list[str]) -> Column:
    """SRC-9 as a gate: the reason of every row that needs the tables ``names`` when one cannot be
    read (``missing_table`` and its name, the first of them), else null. Looked up once a launch, for
    the answer is the same for every file of it."""
    for name in names:
        try:
            spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        except AnalysisException:
            return F.lit(f"missing_table {name}")
    return F.lit(None).cast("string")


def require_inputs(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """SRC-9 for tables named by path: fail fast, before any work, when one cannot be read."""
    missing = []
    for name in names:
        try:
            table(spark, sf_dir, name)
        except AnalysisException:
            missing.append(name)
    if missing:
        raise LookupError(f"required tables missing: {', '.join(missing)}")
