"""Work inside groups, dealt by group into tasks of bounded size.

What a group's rows are exploded to (votes, cells) is many times the rows. Dealt by the exploded keys,
all of it crosses a shuffle, and partitions are merged by their bytes before the next explosion. Dealt by
group, only the rows are shuffled, and everything made of them stays in the task; the number of tasks follows
from the number of rows. Groups too large for one task are found first, and worked on with a
shuffle at every step, as many rows as they may have.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows, exploded ones counted, that a task is given; a bucket of groups with as many is too large for one.
TASK_ROWS = 1_000_000
#: Groups are counted in so many buckets, a bounded table for any number of groups.
BUCKETS = 1 << 18


def bucket(group: str) -> Column:
    return F.pmod(F.xxhash64(group), F.lit(BUCKETS)).cast("int")


def within_groups(rows: DataFrame, group: str, work: Callable[[DataFrame], DataFrame], times: int = 1) -> DataFrame:
    """``work(rows)``, for a ``work`` whose every aggregate, window and join has ``group`` among its keys:
    the rows of one group never meet those of another. ``times`` is how many rows ``work`` makes of one.

    Counts the rows by bucket of groups first (one pass over the column ``group``). Groups of buckets over
    the limit, at most one for every limit's worth of rows, are not placed in one task."""
    limit = max(1, TASK_ROWS // times)
    counts = rows.groupBy(bucket(group).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    seen = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), F.collect_list(F.when(F.col("__n") > limit, F.col("__b"))).alias("large")).first()
    tasks = max(1, math.ceil(seen.n / limit))
    if not seen.large:
        return work(rows.repartition(tasks, group))
    large = bucket(group).isin(seen.large)
    return work(rows.where(~large).repartition(tasks, group)).unionByName(work(rows.where(large)))
