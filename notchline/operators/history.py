"""History up to a time: as-of counts and latest times.

The reference walks a unit's whole history for each run and keeps the rows at or
before the run's time. A self-join per unit would build every pair of a unit's
rows (quadratic for a busy unit), and one running window per unit would put a
busy unit's whole history in one task. Instead the timelines are dealt by ranges
of (key, time) and run range by range (``prefix.running``): a key, or a single day of a
key, may hold any share of the rows.

Where a key's buckets are known to be small, ``levels`` names them and no table is
written: the timeline of each key is cut into nested buckets (for timestamps: the day, then
the exact time) and every prefix value of a time is assembled from

* the totals of the earlier days of its key (a window over one key's days), and
* the running value inside its day (a window over one key-day's distinct times),

so each window ranges over a bounded set: the days of the span, or the distinct
times of one key-day. Finer levels (e.g. ``by_second``) can be passed for
timestamps with sub-second resolution. Inputs are first reduced to one row per
(key, time) by a combining aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notchline.operators.prefix import MAX, SUM, running

Level = Callable[[Column], Column]


def by_day(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def by_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def by_prefix(ts: Column) -> Column:
    """Bucket of a text time (``yyyymmdd...``): its first 8 characters. A prefix of
    fixed length keeps the order of the texts."""
    return F.substring(ts, 1, 8)


def _prefix(timeline: DataFrame, key: str, t: str, levels: Sequence[Level]) -> DataFrame:
    """``timeline(key, t, __n, __h)`` (one row per key and time; ``__h`` a history
    time or null) -> ``(key, t, n_asof, last_ts, prev_ts)``: the sum of ``__n`` at
    or before ``t``, the max of ``__h`` at or before ``t``, and strictly before."""
    bcols = [f"__b{i}" for i in range(len(levels))]
    tl = timeline.withColumns({b: lv(F.col(t)) for b, lv in zip(bcols, levels)})
    incl = (Window.unboundedPreceding, Window.currentRow)
    excl = (Window.unboundedPreceding, -1)

    w = Window.partitionBy(key, *bcols).orderBy(t)
    out = tl.select(
        key, t, *bcols,
        F.sum("__n").over(w.rowsBetween(*incl)).alias("__cum"),
        F.max("__h").over(w.rowsBetween(*incl)).alias("__last_in"),
        F.max("__h").over(w.rowsBetween(*excl)).alias("__prev_in"),
    )
    n_asof, last, prev = F.col("__cum"), [F.col("__last_in")], [F.col("__prev_in")]
    # bucket totals come from the windowed rows themselves (a group's total is its
    # last running count): ``out`` is already partitioned by (key, all buckets),
    # so the finest totals need no exchange and the timeline is computed once
    tot = out.groupBy(key, *bcols).agg(F.max("__cum").alias("__tot"), F.max("__last_in").alias("__hmax"))
    totals = {len(levels) - 1: tot} if levels else {}
    for i in range(len(levels) - 2, -1, -1):
        totals[i] = totals[i + 1].groupBy(key, *bcols[: i + 1]).agg(
            F.sum("__tot").alias("__tot"), F.max("__hmax").alias("__hmax")
        )
    for i in range(len(levels)):
        # earlier sibling buckets b_i inside the same (key, b_0..b_{i-1})
        wl = Window.partitionBy(key, *bcols[:i]).orderBy(bcols[i]).rowsBetween(*excl)
        off = totals[i].select(
            key, *bcols[: i + 1],
            F.coalesce(F.sum("__tot").over(wl), F.lit(0)).alias(f"__off{i}"),
            F.max("__hmax").over(wl).alias(f"__hb{i}"),
        )
        out = out.join(off, [key, *bcols[: i + 1]])
        n_asof = n_asof + F.col(f"__off{i}")
        last.append(F.col(f"__hb{i}"))
        prev.append(F.col(f"__hb{i}"))
    # times of earlier buckets are below every time of the current one: greatest()
    # (which skips nulls) picks the right candidate
    pick = (lambda cs: cs[0]) if len(last) == 1 else (lambda cs: F.greatest(*cs))
    return out.select(
        key, t, n_asof.alias("n_asof"), pick(last).alias("last_ts"), pick(prev).alias("prev_ts")
    )


def asof_counts(history: DataFrame, key: str, ts: str, levels: Sequence[Level] | None = None) -> DataFrame:
    """Per (key, ts) present in ``history``: ``n_asof`` = rows of the key with time
    <= ts (ties included) and ``prev_ts`` = the latest time strictly before ts."""
    per_time = history.groupBy(key, ts).agg(F.count(F.lit(1)).alias("__n"), F.max(ts).alias("__h"))
    if levels is not None:
        return _prefix(per_time, key, ts, levels).select(key, ts, "n_asof", "prev_ts")
    done = running(per_time, [key], [ts], {"n_asof": (SUM, "__n", True), "prev_ts": (MAX, "__h", False)})
    return done.select(key, ts, "n_asof", "prev_ts")


def asof_join(
    runs: DataFrame,
    history: DataFrame,
    key: str | Sequence[str],
    run_ts: str,
    hist_ts: str,
    levels: Sequence[Level] | None = None,
) -> DataFrame:
    """JON-4 for runs that are not history rows themselves: attach to each run the
    number of its key's history rows at or before the run time (``n_asof``) and
    the latest such time (``last_ts``). ``key`` names one column or several, the same
    in both inputs. A run whose key or time is null keeps its row, with 0 and null.

    History is first reduced to one row per key and time; run rows join the timeline with
    weight 0, behind the history row of their own time, and carry their columns, so nothing is
    joined back to the runs. With ``levels`` a RANGE frame (ties included) gives each run its value
    inside its bucket, and the totals of earlier buckets are joined to the run rows."""
    keys = [key] if isinstance(key, str) else list(key)
    kcols = [f"__k{i}" for i in range(len(keys))]
    named = [F.col(k).alias(a) for k, a in zip(keys, kcols)]
    h = history.select(*named, F.col(hist_ts).alias("__t")).dropna().groupBy(*kcols, "__t").agg(F.count(F.lit(1)).alias("__w"))
    r = runs.select(*named, F.col(run_ts).alias("__t"), F.lit(0).cast("bigint").alias("__w"), F.struct(*runs.columns).alias("__run"))
    h = h.withColumns({"__h": F.col("__t"), "__run": F.lit(None).cast(r.schema["__run"].dataType)})
    r = r.withColumn("__h", F.lit(None).cast(h.schema["__h"].dataType))
    tl = h.unionByName(r)
    known = F.lit(True)
    for c in ["__t", *kcols]:
        known = known & F.col(c).isNotNull()

    def result(out: DataFrame, n_asof: Column, last_ts: Column) -> DataFrame:
        return out.select("__run.*", F.when(known, n_asof).otherwise(F.lit(0)).alias("n_asof"), F.when(known, last_ts).alias("last_ts"))

    if levels is None:
        # runs of one key and time, however many, are dealt by a hash of their columns
        placed = tl.withColumns({"__late": F.col("__run").isNotNull(), "__tie": F.xxhash64("__run")})
        order = ["__t", "__late", "__tie"]
        done = running(placed, kcols, order, {"__cum": (SUM, "__w", True), "__last": (MAX, "__h", True)})
        return result(done.where("__late"), F.col("__cum"), F.col("__last"))

    bcols = [f"__b{i}" for i in range(len(levels))]
    tl = tl.withColumns({b: level(F.col("__t")) for b, level in zip(bcols, levels)})
    w = Window.partitionBy(*kcols, *bcols).orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = tl.select("*", F.sum("__w").over(w).alias("__cum"), F.max("__h").over(w).alias("__last"))
    out = inside.where(F.col("__run").isNotNull())
    n_asof, last = F.col("__cum"), [F.col("__last")]
    tot = inside.groupBy(*kcols, *bcols).agg(F.max("__cum").alias("__tot"), F.max("__last").alias("__hmax")) if levels else None
    for i in range(len(levels) - 1, -1, -1):
        on = [*kcols, *bcols[: i + 1]]
        if i < len(levels) - 1:
            tot = tot.groupBy(*on).agg(F.sum("__tot").alias("__tot"), F.max("__hmax").alias("__hmax"))
        earlier = Window.partitionBy(*kcols, *bcols[:i]).orderBy(bcols[i]).rowsBetween(Window.unboundedPreceding, -1)
        off = tot.select(
            *[F.col(c).alias(f"__o{c}") for c in on],
            F.coalesce(F.sum("__tot").over(earlier), F.lit(0)).alias(f"__off{i}"),
            F.max("__hmax").over(earlier).alias(f"__hb{i}"),
        )
        same = F.lit(True)
        for c in on:
            same = same & F.col(c).eqNullSafe(F.col(f"__o{c}"))
        out = out.join(off, same).drop(*[f"__o{c}" for c in on])
        n_asof = n_asof + F.col(f"__off{i}")
        last.append(F.col(f"__hb{i}"))
    return result(out, n_asof, F.greatest(*last) if len(last) > 1 else last[0])
