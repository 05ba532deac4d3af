"""Running totals over keys of any size.

A running window per key puts a busy key in one task. Here rows are dealt by ranges of
(key, order), so a busy key is cut into as many ranges as it needs; each range runs on its
own; and a range whose key began in an earlier one adds that key's totals
before it. There is at most one such key a range, so what is added back is a table of one row a
range, whatever the data. No window is larger than a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notchline.session import scratch_path

SUM, MAX = "sum", "max"
PART = "__part"


def dealt_by_range(df: DataFrame, by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its range in ``__part``, ascending with the columns ``by``. It is written to the
    shared folder: the bounds are sampled once, so a lost executor cannot move rows."""
    spark = df.sparkSession
    cols = [F.col(c) for c in by]
    dealt = (df.repartitionByRange(ranges, *cols) if ranges else df.repartitionByRange(*cols)).withColumn(PART, F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: dict[str, tuple[str, str, bool]], ranges: int | None = None) -> DataFrame:
    """``df`` with a running value a row for each ``{name: (SUM or MAX, column, inclusive)}``: over the rows of the
    same ``keys`` (nulls are one value) before it by ``order``, itself included or not. Rows that tie in
    ``order`` come in any order; make it total where that matters. A sum over no rows is 0, a
    maximum null."""
    fold = {SUM: F.sum, MAX: F.max}
    rows = dealt_by_range(df, [*keys, *order], ranges)
    w = Window.partitionBy(PART, *keys).orderBy(*order)
    upto, before = (w.rowsBetween(Window.unboundedPreceding, e) for e in (Window.currentRow, -1))
    inside = rows.select("*", *[fold[f](c).over(upto if incl else before).alias(name) for name, (f, c, incl) in out.items()])
    totals = rows.groupBy(PART, *keys).agg(*[fold[f](c).alias(name) for name, (f, c, _) in out.items()])
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    added = totals.select(
        F.col(PART).alias("__p"), *[F.col(k).alias(f"__own{i}") for i, k in enumerate(keys)],
        *[fold[f](name).over(earlier).alias(f"__add_{name}") for name, (f, _, _) in out.items()],
        F.count(F.lit(1)).over(earlier).alias("__earlier"),
    ).where(F.col("__earlier") > 0)  # a row a range at most, hence the broadcast
    same = F.col(PART) == F.col("__p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__own{i}"))
    joined = inside.join(F.broadcast(added), same, "left")
    both = {
        name: F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"__add_{name}"), F.lit(0)) if f == SUM else F.greatest(name, f"__add_{name}")
        for name, (f, _, _) in out.items()
    }
    return joined.select(*df.columns, *[v.alias(name) for name, v in both.items()])
