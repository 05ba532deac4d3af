"""The nested file envelope: ``operational_metadata.buffer_server.{filename, file_contents}``.

One record per inspected file. The reference lists a directory, reads each file
on its own and unions the results in a driver loop; here the whole directory is
one scan (one task per file split), and nested schema pruning reads only the
two leaves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES_SCHEMA = T.StructType(
    [
        T.StructField("filename", T.StringType(), True),
        T.StructField("file_contents", T.StringType(), True),
    ]
)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField(
            "operational_metadata",
            T.StructType(
                [
                    T.StructField(
                        "buffer_server",
                        T.StructType(
                            [
                                T.StructField("filename", T.StringType(), True),
                                T.StructField("file_contents", T.BinaryType(), True),
                            ]
                        ),
                        True,
                    )
                ]
            ),
            True,
        )
    ]
)

_LEAF = "operational_metadata.buffer_server"


def empty_files(spark: SparkSession) -> DataFrame:
    """SRC-3: the typed empty files table."""
    return spark.createDataFrame([], FILES_SCHEMA)


def to_envelope(files: DataFrame) -> DataFrame:
    """Wrap a ``(filename, file_contents)`` table into the nested envelope
    (contents as bytes), the shape the upstream system delivers."""
    return files.select(
        F.struct(
            F.struct(
                F.col("filename"),
                F.col("file_contents").cast("binary").alias("file_contents"),
            ).alias("buffer_server")
        ).alias("operational_metadata")
    )


def write_envelope(files: DataFrame, path: str, fmt: str = "parquet") -> None:
    to_envelope(files).write.format(fmt).mode("overwrite").save(path)


def read_envelope(
    spark: SparkSession, path: str, fmt: str = "parquet", with_source: bool = False
) -> DataFrame:
    """SRC-1/SRC-2/PRJ-1..3: read every file directly in ``path`` (not recursive,
    like the reference's listing) and flatten to ``(filename, file_contents)``
    with the contents as text. ``fmt`` is ``avro`` where that module is on the
    classpath; the schema is the same. ``with_source`` adds the path of the file
    each record came from (``_metadata.file_path``), the reference's listing."""
    raw = spark.read.format(fmt).option("recursiveFileLookup", "false").load(path)
    cols = [
        F.col(f"{_LEAF}.filename").alias("filename"),
        F.col(f"{_LEAF}.file_contents").cast("string").alias("file_contents"),
    ]
    if with_source:
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    return raw.select(*cols)


def union_files(spark: SparkSession, *sources: DataFrame) -> DataFrame:
    """SET-1: the empty typed seed unioned by name with each source."""
    out = empty_files(spark)
    for s in sources:
        out = out.unionByName(s.select("filename", "file_contents"))
    return out


def read_with_rejects(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """SRC-1, CTL-2: ``(records, rejects)`` of a folder that may hold damaged files.

    ``records`` are ``(source_file, filename, file_contents)`` of all records that can be read and have a name and
    contents. ``rejects`` are rows ``(source_file, filename, reason)``: ``unreadable`` for a file
    without any readable record, ``no file name`` or ``no contents`` for a record. A damaged
    file never ends the job. The listing of the folder is itself a scan (names, no
    contents), and the two meet by file name. Files of no bytes are not listed by Spark: they hold
    nothing and are no rejects."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("source_file")
    )
    reader = spark.read.format(fmt).schema(ENVELOPE_SCHEMA).option("recursiveFileLookup", "false").option("ignoreCorruptFiles", "true")
    raw = reader.load(path).select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col(f"{_LEAF}.filename").alias("filename"),
        F.col(f"{_LEAF}.file_contents").cast("string").alias("file_contents"),
    )
    reason = F.when(F.col("filename").isNull(), F.lit("no file name")).when(F.col("file_contents").isNull(), F.lit("no contents"))
    records = raw.where(reason.isNull())
    bad_records = raw.where(reason.isNotNull()).select("source_file", "filename", reason.alias("reason"))
    bad_files = listed.join(raw.select("source_file").distinct(), "source_file", "left_anti").select(
        "source_file", F.lit(None).cast("string").alias("filename"), F.lit("unreadable").alias("reason")
    )
    return records, bad_files.unionByName(bad_records)
