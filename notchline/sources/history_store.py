"""A stored history laid out for lookups (SRC-7, SRC-8).

The reference asks a key-value store for a prefix range and then for single rows, once per
file. A table bucketed and sorted by its key answers many such questions at once: ids
that are joined to it are dealt by the buckets' hash, and the table itself, whatever its
size, is read where it lies. A few given keys read only their buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline.session import scratch_path

ID = "id"


class KeyedTable:
    """A table of the session's catalog, bucketed and sorted by its column ``id``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    @classmethod
    def write(cls, rows: DataFrame, key: Column, buckets: int, path: str | None = None, name: str | None = None) -> KeyedTable:
        """Store ``rows`` under ``key`` (as column ``id``; rows without it are left out, as no lookup finds them) in
        files at ``path`` (default: the shared folder). One task writes a bucket's file, so choose
        ``buckets`` so that one fits a task: about the table's size / 200 MB."""
        spark = rows.sparkSession
        name = name or f"keyed_{uuid.uuid4().hex}"
        path = path or scratch_path(spark, name)
        keyed = rows.withColumn(ID, key).where(F.col(ID).isNotNull()).repartition(buckets, ID)
        keyed.write.bucketBy(buckets, ID).sortBy(ID).option("path", path).mode("overwrite").saveAsTable(name)
        return cls(spark, name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def of(self, asked: DataFrame, key: str, how: str = "inner") -> DataFrame:
        """``asked`` joined with the rows stored under its column ``key``: only ``asked`` is shuffled."""
        return asked.join(self.table(), asked[key] == F.col(ID), how)

    def get(self, keys: Sequence) -> DataFrame:
        """The rows of a few keys: a filter that reads the keys' buckets only, and of these the
        parts whose range of sorted keys holds one."""
        return self.table().where(F.col(ID).isin(list(keys)))


def store_history(index: DataFrame, index_key: str, rows: DataFrame, row_key: str, separator: str, buckets: int) -> tuple[KeyedTable, KeyedTable]:
    """The history index under the id that its key begins with (up to ``separator``), and
    the history rows under their key."""
    return (
        KeyedTable.write(index, F.substring_index(index_key, separator, 1), buckets),
        KeyedTable.write(rows, F.col(row_key), buckets),
    )
