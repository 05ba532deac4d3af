"""Incremental ingestion: each launch processes only the files not seen before."""

from pyspark.sql import functions as F

from notchline.plans.ingest_queries import STANDIN_MARKER, doc_files
from notchline.session import scratch_path
from notchline.sources.envelope import to_envelope
from notchline.sources.tables import Tables
from notchline.streaming.ingest import file_facts, start_ingest

from .conftest import SF_SMALL


def test_ingest_is_incremental_and_exactly_once(spark):
    t = Tables(spark, SF_SMALL)
    files = doc_files(t)
    first = files.where(F.col("filename").startswith("src0"))
    rest = files.where(~F.col("filename").startswith("src0"))
    src = scratch_path(spark, "inbox")
    out = scratch_path(spark, "ingested")
    ckpt = scratch_path(spark, "ingest-ckpt")

    to_envelope(first).write.mode("append").parquet(src)
    q = start_ingest(spark, src, out, ckpt, marker=STANDIN_MARKER)
    q.awaitTermination()
    n1 = spark.read.parquet(out).count()
    assert n1 == first.count() > 0

    to_envelope(rest).write.mode("append").parquet(src)
    q = start_ingest(spark, src, out, ckpt, marker=STANDIN_MARKER)
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == files.count()
    assert got.select("filename").distinct().count() == files.count()

    # the stream computes the same facts as the batch form
    batch = file_facts(files, STANDIN_MARKER)
    cols = ["filename", "version", "scale", "n_lines", "n_chars", "head"]
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
