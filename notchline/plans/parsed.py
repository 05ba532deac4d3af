"""The runs' files, parsed once and stored (SCL-17, FLT-6, SNK-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline.operators.blocks import KIND_FILE, KIND_POINT, parse_files, run_facts
from notchline.operators.sinks import keep_last
from notchline.plans import model
from notchline.session import scratch_path
from notchline.sources.tables import Tables

KEY = "o_orderkey"


class ParsedFiles:
    """The parsed rows of all files, written by one pass over the texts to the shared folder,
    a directory a kind: gates, header rows and points each read only their own."""

    def __init__(self, spark: SparkSession, t: Tables, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "parsed-files")
        rows = parse_files(model.file_texts(t), KEY, "text")
        self.schema = rows.schema
        rows.write.partitionBy("kind").parquet(self.path)

    def rows(self, *kinds: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).where(F.col("kind").isin(*kinds))

    def facts(self) -> DataFrame:
        """One row a run: dialect, header map, point counts and class sums."""
        flag = F.col("flag")
        return run_facts(self.rows(KIND_FILE, KIND_POINT), KEY, F.abs(model.flag_class(flag)), model.flag_is_back(flag))

    def fields(self) -> DataFrame:
        """(key, name, value) of every header field."""
        return self.rows(KIND_FILE).select(KEY, F.explode("header").alias("name", "value"))

    def points(self) -> DataFrame:
        """(run_id, x, y, is_back) of every point line."""
        return self.rows(KIND_POINT).select(F.col(KEY).alias("run_id"), "x", "y", model.flag_is_back(F.col("flag")).alias("is_back"))

    def last_points(self) -> DataFrame:
        """(key, name, value, x, y, flag): the last line of every point id."""
        return keep_last(self.rows(KIND_POINT), [KEY, "name"], ["block", "pos"], ["value", "x", "y", "flag"]).drop("block", "pos")
