"""Sinks: what the reference writes as wide key-value rows, written as tables.

* long rows ``(rowkey, qualifier, value)`` by unpivot instead of one put per cell;
* keep-last per key as an aggregate (``max`` of a struct ordered by the
  sequence; it plans as a sort aggregate), the equivalent of a map put or a cell overwrite;
* a put batch has no Parquet counterpart: files are sized in bytes by the write
  (``batch`` caps rows per file for a caller who wants it);
* per-device tables as a partitioned write, rows rebalanced by device before it;
* puts into a stored table as a keep-last merge of the touched partitions, which alone
  are written again;
* retention as a predicate on time against the newest row (a scalar subquery,
  evaluated inside the same plan), or as directories of a table partitioned by month.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline.session import scratch_path
from notchline.sources import folders


def unpivot_long(df: DataFrame, rowkey: str, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """SNK-2: one ``(rowkey, qualifier, value)`` row per non-null cell, values as text,
    with the columns of ``carry`` beside it."""
    cast = df.select(rowkey, *carry, *[F.col(c).cast("string").alias(c) for c in columns])
    long = cast.unpivot([rowkey, *carry], list(columns), "qualifier", "value")
    long = long.select(rowkey, "qualifier", "value", *carry)
    return long.where(F.col("value").isNotNull())


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """AGG-6 / SNK-6: the row with the greatest ``order`` per key (a later put of
    the same cell wins). A combining aggregate: a hot key is reduced map-side."""
    m = F.max(F.struct(*[F.col(c) for c in (*order, *payload)])).alias("__last")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"__last.{c}").alias(c) for c in (*order, *payload)])


def map_of(df: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """AGG-8: one row per ``keys`` with the map of its (name, value) pairs, names ascending. Names must be
    unique per key (``keep_last``) and not null. The map is one value: bounded by the names of a key."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(name), F.col(value))))
    return df.groupBy(*keys).agg(F.map_from_entries(pairs).alias("map"))


def last_put(puts: Column) -> Column:
    """Row-local last-wins over an array of ``struct(seq, value)`` puts; null
    values are puts that did not happen."""
    done = F.filter(puts, lambda p: p["value"].isNotNull())
    return F.element_at(F.array_sort(done), -1)["value"]


# batches generated per row at most; a key with more is split into chunks first
BATCH_CHUNK = 100_000


def batch_counts(counts: DataFrame, key: str, n: str, batch: int, chunk: int = BATCH_CHUNK) -> DataFrame:
    """WIN-2 at the level that matters: rows per write batch of ``batch`` rows,
    per key, from the key's row count alone (every batch is full but the last).
    No per-row numbering, so no window gathers a key's rows.

    A key's batch numbers are generated in chunks of at most ``chunk`` and the
    chunks are spread over tasks before they are expanded, so a key holding a
    large share of the rows never builds one huge array in one task."""
    nb = F.ceil(F.col(n) / F.lit(batch)).cast("bigint")
    n_chunks = F.ceil(nb / F.lit(chunk)).cast("bigint")
    chunks = counts.select(
        key, F.col(n), nb.alias("__nb"), F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks - 1)).alias("__c")
    ).repartition(key, "__c")
    first = F.col("__c") * chunk
    last = F.least(first + chunk, F.col("__nb")) - 1
    return chunks.select(key, F.col(n), F.explode(F.sequence(first, last)).alias("batch")).select(
        key,
        F.col("batch").cast("int").alias("batch"),
        F.least(F.lit(batch).cast("bigint"), F.col(n) - F.col("batch") * batch).alias("n_rows"),
    )


def write_partitioned(
    df: DataFrame, path: str, by: str | Sequence[str] | None, batch: int | None = None, mode: str = "append"
) -> None:
    """SNK-1 / SNK-7: one directory per value of ``by``, a column or several (``None``: one shared
    table, the reference's all-together switch). Creates the table on first
    write; ``batch`` caps rows per file like the reference's put batch. A re-run
    of a whole job should pass ``mode="overwrite"``; task retries are handled by
    the output committer either way. Rows are rebalanced by ``by`` first, so a
    directory gets files of the advisory size (a large one several), not one from every task."""
    by = [by] if isinstance(by, str) else list(by or ())
    if by:
        df = df.hint("rebalance", *by)
    w = df.write.mode(mode).format("parquet")
    if batch:
        w = w.option("maxRecordsPerFile", batch)
    if by:
        w = w.partitionBy(*by)
    w.save(path)


def upsert(df: DataFrame, path: str, keys: Sequence[str], by: str | Sequence[str] | None, order: Sequence[str] = ()) -> list[dict]:
    """SNK-6 / SNK-7 across runs: put the rows of ``df`` into the table at ``path``, partitioned
    by ``by``. A stored row with the same ``keys`` in the same partition is replaced; of several rows of ``df``
    with one key the greatest ``order`` stays. Other rows stay as they are. Creates the table.

    Only the partitions that ``df`` touches are read and written again (the list of these, one
    entry a directory, is returned). Both the new rows and the merged ones are first written to
    the shared scratch folder, so a run that is ended half-way leaves the table
    as it was or can be repeated."""
    spark = df.sparkSession
    by = [by] if isinstance(by, str) else list(by or ())
    rest = [c for c in df.columns if c not in (*keys, *by)]
    payload = [c for c in rest if c not in order]
    scratch = [scratch_path(spark, "upsert-new"), scratch_path(spark, "upsert-merged")]
    keep_last(df, [*keys, *by], order or payload[:1], payload if order else payload[1:]).select(df.columns).write.parquet(scratch[0])
    new = spark.read.schema(df.schema).parquet(scratch[0])
    touched = [r.asDict() for r in new.select(*by).distinct().collect()] if by else []  # directories
    if folders.exists(spark, path):
        stored = spark.read.schema(df.schema).parquet(path)
        if by:
            stored = stored.where(_any_of(touched))
        both = stored.withColumn("__run", F.lit(0)).unionByName(new.withColumn("__run", F.lit(1)))
        keep_last(both, [*keys, *by], ["__run"], rest).select(df.columns).write.parquet(scratch[1])
        new = spark.read.schema(df.schema).parquet(scratch[1])
    if touched or not by:
        w = new.hint("rebalance", *by) if by else new
        w = w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (w.partitionBy(*by) if by else w).parquet(path)
    for folder in scratch:
        folders.delete(spark, folder)
    return touched


def _any_of(partitions: Sequence[dict]) -> Column:
    """Whether a row lies in one of the partitions; a filter on partition columns alone."""
    out = F.lit(False)
    for p in partitions:
        here = F.lit(True)
        for c, v in p.items():
            here = here & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        out = out | here
    return out


def expire_partitions(spark: SparkSession, path: str, column: str, oldest_kept: str) -> list[str]:
    """SNK-8 without reading a row: delete the directories ``column=<value>`` of a table whose value
    is below ``oldest_kept`` (texts; ISO dates sort as they should). The default partition of
    null values stays. Returns the values that went."""
    gone = [v for v in folders.partition_values(spark, path, column) if v != folders.NULL_PARTITION and v < oldest_kept]
    for v in gone:
        folders.delete(spark, f"{path.rstrip('/')}/{column}={v}")
    return gone


def retained(spark: SparkSession, path: str, schema, column: str, ts: str, days: int) -> DataFrame:
    """SNK-8 over a table partitioned by the month (``column``, a date) of its time ``ts``: the newest
    month alone tells the newest time, older months than the retention reaches are
    dropped as directories, and the rows left are read with a partition filter and, for the oldest
    month, the exact time. Empty table: no rows."""
    rows = spark.read.schema(schema).parquet(path)
    months = [v for v in folders.partition_values(spark, path, column) if v != folders.NULL_PARTITION]
    if not months:
        return rows.limit(0)
    newest = rows.where(F.col(column) == F.lit(max(months)).cast("date")).agg(F.max(ts)).first()[0]
    limit = newest - timedelta(days=days)
    first = limit.date().replace(day=1)
    expire_partitions(spark, path, column, first.isoformat())
    return spark.read.schema(schema).parquet(path).where((F.col(column) >= F.lit(first)) & (F.col(ts) >= F.lit(limit)))


def retention_filter(df: DataFrame, ts: str, days: int) -> DataFrame:
    """SNK-8: rows no older than ``days`` before the newest row. The newest time is
    a scalar subquery of the same plan (no driver round trip)."""
    newest = df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.expr(f"INTERVAL {int(days)} DAYS"))
