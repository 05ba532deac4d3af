"""Band (tolerance) joins as equi-joins on buckets.

``|a - b| <= tol`` has no equi-key, so Spark would plan it as a nested-loop join.
Cutting the value axis into buckets of width ``w`` slightly over ``tol`` means a
matching pair is at most one bucket apart: one side keeps its own bucket, the
other side is repeated into its bucket and both neighbours, and the pair meets
on an ordinary hash/sort-merge key. The exact predicate is then applied as a
residual, so the result equals the nested-loop form row for row.

Cost: the repeated side grows 3x (repeat the smaller side); candidate pairs are
those within about ``2 * tol`` of each other, so the work follows the size of
the answer rather than the product of the inputs. A bucket that holds a large
share of both sides is split by adaptive skew-join handling like any hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket width over the tolerance: |a - b| <= tol < width keeps a pair within one
# bucket of each other even after rounding in the division.
WIDTH_SLACK = 1.001
_BK = "__band_bucket"


def bucket_of(value: Column, tol: Column | float) -> Column:
    return F.floor(value / (tol * WIDTH_SLACK)).cast("bigint")


def neighbour_buckets(value: Column, tol: Column | float) -> Column:
    b = bucket_of(value, tol)
    return F.array(b - 1, b, b + 1)


def band_join(
    left: DataFrame,
    right: DataFrame,
    left_value: str,
    right_value: str,
    tol: float | str,
    *,
    keys: Sequence[str] = (),
    strict: bool = False,
    repeat: str = "right",
    residual: Column | None = None,
    how: str = "inner",
) -> DataFrame:
    """Rows of ``left`` x ``right`` with ``|left_value - right_value| <= tol``.

    ``tol`` is a number, or the name of a key column (listed in ``keys``) whose
    value is the tolerance for the rows of that key, e.g. a parameter profile.
    ``strict`` uses ``<`` instead of ``<=``. ``keys`` are extra equality keys
    present on both sides; other column names must not collide. ``residual`` is an
    extra predicate over the joined row. ``repeat`` names the side repeated into
    three buckets (choose the smaller). ``how`` is ``inner``, ``left_semi`` or
    ``left_anti`` (the latter two repeat the right side).
    """
    if repeat not in ("left", "right"):
        raise ValueError("repeat must be 'left' or 'right'")
    if how != "inner" and repeat != "right":
        raise ValueError("semi/anti band joins repeat the right side")
    if isinstance(tol, str):
        if tol not in keys:
            raise ValueError("a tolerance column must be one of the keys")
        tol_expr: Column | float = F.col(tol)
    else:
        if not tol > 0:
            raise ValueError("tol must be positive")
        tol_expr = float(tol)

    if repeat == "right":
        lside = left.withColumn(_BK, bucket_of(F.col(left_value), tol_expr))
        rside = right.withColumn(_BK, F.explode(neighbour_buckets(F.col(right_value), tol_expr)))
    else:
        lside = left.withColumn(_BK, F.explode(neighbour_buckets(F.col(left_value), tol_expr)))
        rside = right.withColumn(_BK, bucket_of(F.col(right_value), tol_expr))

    eq = [lside[k] == rside[k] for k in (*keys, _BK)]
    t = lside[tol] if isinstance(tol, str) else F.lit(float(tol))
    diff = F.abs(lside[left_value] - rside[right_value])
    cond = reduce(lambda a, b: a & b, eq) & (diff < t if strict else diff <= t)
    if residual is not None:
        cond = cond & residual
    out = lside.join(rside, cond, how)
    if how == "inner":
        out = out.drop(lside[_BK]).drop(rside[_BK])
        for k in keys:
            out = out.drop(rside[k])
    else:
        out = out.drop(_BK)
    return out


def multi_band_join(
    left: DataFrame,
    right: DataFrame,
    bands: Sequence[tuple],
    *,
    keys: Sequence[tuple[str, str]] = (),
    residual: Column | None = None,
    how: str = "inner",
) -> DataFrame:
    """Rows with ``|l - r| <= tol`` for every ``(l, r, tol)`` in ``bands`` and
    ``left[a] == right[b]`` for every ``(a, b)`` in ``keys``.

    Each band gets its own bucket; the right side is repeated into the
    neighbouring bucket cells, so candidates are close in every dimension at once
    (a busy key contributes only pairs that are near in time *and* value, never
    all of its pairs). A band given as ``(l, r, tol, "left_ge")`` promises that the
    residual keeps only ``l >= r`` (e.g. "earlier" partners): the right side then
    needs its own bucket and the next one only. Column names of the two sides
    must be distinct.

    The repeated side is never broadcast: Spark's estimate does not see the repeats (3 to the
    number of bands), and a broadcast table is built on the driver.
    """
    lcols, rcols = [], []
    lside, rside = left, right
    for i, band in enumerate(bands):
        lv, rv, tol = band[:3]
        one_sided = len(band) > 3 and band[3] == "left_ge"
        lb, rb = f"__lb{i}", f"__rb{i}"
        lside = lside.withColumn(lb, bucket_of(F.col(lv), float(tol)))
        b = bucket_of(F.col(rv), float(tol))
        cells = F.array(b, b + 1) if one_sided else neighbour_buckets(F.col(rv), float(tol))
        rside = rside.withColumn(rb, F.explode(cells))
        lcols.append(lb)
        rcols.append(rb)
    eq = [lside[a] == rside[b] for a, b in keys]
    eq += [lside[a] == rside[b] for a, b in zip(lcols, rcols)]
    cond = reduce(lambda a, b: a & b, eq)
    for band in bands:
        lv, rv, tol = band[:3]
        cond = cond & (F.abs(lside[lv] - rside[rv]) <= float(tol))
    if residual is not None:
        cond = cond & residual
    out = lside.join(rside.hint("merge"), cond, how)
    return out.drop(*lcols, *rcols)


def band_counts(left: DataFrame, right: DataFrame, key: str, value: str, n: str, tol: str) -> DataFrame:
    """``(key, tol, n_pairs)`` rows whose sum by key is the number of pairs with ``|left - right| <= tol``, of
    rows that stand for ``n`` each, without building the pairs. ``tol`` is a column that the key decides.

    Values fall into buckets a little under half a tolerance wide. Buckets up to one apart match
    whole, so their sums multiply; buckets four or more apart never match; those two and three
    apart are at the edge, and only there do values meet, compared as they are. Each bucket has five
    neighbours to meet and not its pairs: rows grow with the values near an edge."""
    width = F.col(tol) / (2.0 * WIDTH_SLACK)
    low, high = (x.select(key, tol, F.col(value).alias(v), F.col(n).alias(m), F.floor(F.col(value) / width).cast("bigint").alias("__b")) for x, v, m in ((left, "__l", "__ln"), (right, "__r", "__rn")))
    sums = [x.groupBy(key, tol, "__b").agg(F.sum(m).alias(m)) for x, m in ((low, "__ln"), (high, "__rn"))]

    def moved(df: DataFrame, *steps: int) -> DataFrame:
        return df.withColumn("__b", F.explode(F.array(*[F.col("__b") + s for s in steps])))

    whole = sums[0].join(moved(sums[1], -1, 0, 1), [key, tol, "__b"]).select(key, tol, (F.col("__ln") * F.col("__rn")).alias("n_pairs"))
    edge = low.join(moved(high, -3, -2, 2, 3), [key, tol, "__b"]).where(F.abs(F.col("__r") - F.col("__l")) <= F.col(tol))
    return whole.unionByName(edge.select(key, tol, (F.col("__ln") * F.col("__rn")).alias("n_pairs")))
