"""JON-9: consolidation of detections with earlier ones of the same entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.operators.band_join import multi_band_join
from notchline.operators.components import components
from notchline.session import scratch_path

DAY_US = 86400 * 1_000_000


def micros(ts: F.Column) -> F.Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def consolidate(
    detections: DataFrame,
    ids: Sequence[str],
    keys: Sequence[str],
    ts: str,
    r: str,
    theta: str,
    days: int = C.HIST_DAYS,
    r_tol: float = C.CONSOLIDATE_VALUE_TOL,
    theta_tol: float = C.ANGLE_TOLERANCE,
) -> DataFrame:
    """Per detection (``ids``) how many earlier detections of the same ``keys``, at most
    ``days`` back, lie within both bands (radius and angle), and the time of the latest: columns
    ``n_similar`` (0 kept) and ``last_similar``.

    One bucketed join over time, radius and angle, keyed by the entity: only
    detections near in all three meet; the count combines before its shuffle."""
    named = {**{c: f"__id{i}" for i, c in enumerate(ids)}}
    a = detections.select(
        *[F.col(c).alias(n) for c, n in named.items()], *[F.col(k).alias(f"__a{i}") for i, k in enumerate(keys)],
        F.col(r).alias("__ar"), F.col(theta).alias("__at"), micros(F.col(ts)).alias("__ats"),
    )
    b = detections.select(
        *[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)],
        F.col(r).alias("__br"), F.col(theta).alias("__bt"), micros(F.col(ts)).alias("__bts"), F.col(ts).alias("__ts"),
    )
    pairs = multi_band_join(
        a, b,
        [
            # b is earlier than a (residual), so b's time bucket is a's or the one before
            ("__ats", "__bts", float(days * DAY_US), "left_ge"),
            ("__ar", "__br", r_tol),
            ("__at", "__bt", theta_tol),
        ],
        keys=[(f"__a{i}", f"__b{i}") for i in range(len(keys))],
        residual=F.col("__bts") < F.col("__ats"),
    )
    names = list(named.values())
    none = F.lit(None).cast(b.schema["__ts"].dataType)
    rows = a.select(*names, F.lit(0).alias("__one"), none.alias("__ts")).unionByName(pairs.select(*names, F.lit(1).alias("__one"), "__ts"))
    out = rows.groupBy(*names).agg(F.sum("__one").cast("bigint").alias("n_similar"), F.max("__ts").alias("last_similar"))
    return out.withColumnsRenamed({n: c for c, n in named.items()})



def near_groups(points: DataFrame, node: str, keys: Sequence[str], bands: Sequence[tuple[str, int]]) -> DataFrame:
    """JON-9 as groups: ``(node, group_id, group_size)``. Two rows of the same ``keys`` are near when they
    differ by at most the tolerance in every band ``(column, tolerance)``; columns and tolerances are whole numbers. A
    group is all that is reachable over near rows; its id is its least ``node`` (unique in ``points``, not
    null). A row with a null in a key or a band is a group of its own.

    Rows fall into cells as wide as the tolerances, so all rows of a cell are near each other and a
    cell is one node, however many rows it has; only cells that touch can hold near rows. Cells that
    differ in one band alone are decided by their least and greatest value there. Cells that touch at an
    edge or a corner are compared row by row, but only where they are not in one group by then, and only
    the rows within the other cell's reach: inside a dense region nothing is left to compare."""
    n = len(bands)
    ks, vs, cs = ([f"__{x}{i}" for i in range(m)] for x, m in (("k", len(keys)), ("v", n), ("c", n)))
    tol = [int(t) for _, t in bands]
    named = points.select(
        F.col(node).alias("__node"), *[F.col(k).alias(a) for k, a in zip(keys, ks, strict=True)],
        *[F.col(b).cast("bigint").alias(a) for (b, _), a in zip(bands, vs, strict=True)],
    )
    cell = [F.expr(f"({v} - pmod({v}, {t}L)) div {t}L").alias(c) for v, c, t in zip(vs, cs, tol, strict=True)]
    rows = _stored(named.dropna(subset=[*ks, *vs]).select("__node", *ks, *vs, *cell), "near-rows")
    box = [f(v).alias(f"{v}_{name}") for v in vs for f, name in ((F.min, "lo"), (F.max, "hi"))]
    cells = _stored(rows.groupBy(*ks, *cs).agg(F.min("__node").alias("cell"), *box), "near-cells")

    def reach(step: Sequence[int], renamed: dict) -> DataFrame:
        """Pairs of cells ``step`` apart whose boxes are within the tolerances."""
        there = cells.select(
            *[F.col(k).alias(f"{k}_b") for k in ks], *[(F.col(c) - d).alias(f"{c}_b") for c, d in zip(cs, step, strict=True)],
            F.col("cell").alias("other"), *[F.col(f"{v}_{e}").alias(f"{v}_{e}_b") for v in vs for e in ("lo", "hi")],
        )
        on = [cells[x] == there[f"{x}_b"] for x in (*ks, *cs)]
        for v, d, t in zip(vs, step, tol, strict=True):
            if d:
                gap = F.col(f"{v}_lo_b") - F.col(f"{v}_hi") if d > 0 else F.col(f"{v}_lo") - F.col(f"{v}_hi_b")
                on.append(gap <= t)
        return cells.join(there, on).select("cell", "other", *[F.col(a).alias(b) for a, b in renamed.items()])

    steps = [s for s in product((0, 1, -1), repeat=n) if next((d for d in s if d), -1) > 0]  # one of each opposite pair
    along = [reach(s, {}) for s in steps if sum(map(abs, s)) == 1]
    first = _stored(components(reduce(DataFrame.unionByName, along), "cell", "other"), "near-first")

    def rooted(pairs: DataFrame, c: str, out: str) -> DataFrame:
        return pairs.join(first.select(F.col("node").alias(c), F.col("root").alias("__r")), c, "left").withColumn(out, F.coalesce("__r", c)).drop("__r")

    bounds = {f"{v}_{e}{s}": f"{v}_{e}{s or '_a'}" for v in vs for e in ("lo", "hi") for s in ("", "_b")}
    across = [reach(s, bounds) for s in steps if sum(map(abs, s)) > 1]
    linked = first.select(F.col("root").alias("a"), F.col("root").alias("b")).limit(0)
    if across:
        apart = rooted(rooted(reduce(DataFrame.unionByName, across), "cell", "root_a"), "other", "root_b").where("root_a <> root_b")
        member = rows.join(cells.select(*ks, *cs, "cell"), [*ks, *cs]).select("cell", *vs)
        one = apart.join(member, "cell")
        for v, t in zip(vs, tol, strict=True):
            one = one.where((F.col(v) >= F.col(f"{v}_lo_b") - t) & (F.col(v) <= F.col(f"{v}_hi_b") + t))
        two = member.select(F.col("cell").alias("other"), *[F.col(v).alias(f"{v}_o") for v in vs])
        pairs = one.join(two, "other")
        for v, t in zip(vs, tol, strict=True):
            pairs = pairs.where(F.abs(F.col(v) - F.col(f"{v}_o")) <= t)
        linked = pairs.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()
    second = components(linked, "a", "b").select(F.col("node").alias("__first"), F.col("root").alias("__second"))
    group = rooted(cells, "cell", "__first").join(second, "__first", "left").select(*ks, *cs, F.coalesce("__second", "__first").alias("group_id"))
    found = rows.join(group, [*ks, *cs]).select("__node", "group_id")
    every = named.select("__node").join(found, "__node", "left").select("__node", F.coalesce("group_id", "__node").alias("group_id"))
    size = every.groupBy("group_id").agg(F.count(F.lit(1)).alias("group_size"))
    return every.join(size, "group_id").select(F.col("__node").alias(node), "group_id", "group_size")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
