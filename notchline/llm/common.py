"""Helpers that the operators share: tables written to the shared folder, ids."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline.session import scratch_path
from notchline.sources import tables

__all__ = ["table", "stored", "drop_stored", "swept", "tidy", "text_of", "scratch_path", "without", "id_text_key", "named", "every", "fresh"]

#: Most rows of ids (about 100 bytes each on a worker) that are broadcast.
BROADCAST_IDS = 500_000


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Rows of an Arrow batch, where the session does not say: texts may be long.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tidy(run: Callable) -> Callable:
    """``run`` (a function of Arrow batches) that gives memory back to the system when a task
    ends: a Python worker lives on, and what its allocators keep would add up over stages."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return go


def give_back() -> None:
    """Return what this process' allocators keep to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def importable(spark: SparkSession) -> None:
    """Put this package's folder on the Python path of the tasks that follow, so that they
    can import it whatever the working folder is, and keep Arrow batches small. Where executors do not see the folder the
    package must be shipped with the job (``--py-files``), as any other."""
    if spark.conf.get(_BATCH) == "10000" and not spark.sparkContext.getConf().contains(_BATCH):  # Spark's default
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return tables.table(spark, sf_dir, name)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet (tables of texts are better off with zstd) under ``spark.checkpoint.dir`` and read it back: the
    lineage ends at files that every executor sees, so a lost executor costs
    only its own running tasks. The path is on the result as ``stored_path``."""
    spark = df.sparkSession
    importable(spark)
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_path = path
    return back


def swept(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more; else
    they stay on the executors' disks until the driver happens to collect its garbage."""
    give_back()
    spark.sparkContext._jvm.System.gc()


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by ``stored`` (once nothing reads it any more)."""
    spark: SparkSession = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def named(name: str) -> Column:
    """The column of this very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def every(df: DataFrame) -> list[Column]:
    """All columns of ``df``."""
    return [named(c) for c in df.columns]


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, longer as needed not to be a column of ``frames`` (in any case)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(col: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce((F.col(col) if col.startswith("`") else named(col)).cast("string"), F.lit(""))


def without(rows: DataFrame, gone: DataFrame, on: Column, kind: str = "left_anti") -> DataFrame:
    """``rows`` whose ``on`` (never null) is not among the values of ``gone``' only column
    (among them, if ``kind`` is 'left_semi'). These are broadcast if they are counted to
    be few, else the join shuffles."""
    name = fresh("__gone", rows)
    gone = gone.select(named(gone.columns[0]).alias(name)).distinct()
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return rows.join(gone, on == F.col(name), kind)


def id_text_key(doc_id: str, text: str) -> Column:
    """A string that stands for a row's id (null included) and text."""
    return F.concat_ws("-", F.coalesce(named(doc_id).cast("string"), F.lit("null")), F.hex(F.xxhash64(text_of(text))))
