"""Line patterns in a run's points, and the per-run summary built from them.

The reference hands each run's points to a detector whose body is not published
and gets back lines in polar form ``(r, theta)``. Here detection is grouped
voting in (theta, r) bins -- the Hough transform (Duda & Hart, 1972): every point
votes once per theta bin for the r of the line through it; every bin with enough
votes is a line. On Spark that is two combining aggregates: equal points are first
counted, then each distinct point votes with its count, and votes are summed per bin. Points are
dealt by run into tasks of bounded size, where their votes stay (``groups``). No run larger than a task is
gathered for voting: its votes are shuffled by bin. What a run's numbering window sees is its
lines, as many as the parameter space has bins (theta bins x the field's extent / r bin), however
many points it has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.operators.groups import within_groups


def round6(v: F.Column) -> F.Column:
    """``v`` rounded half-up to 6 decimals in double arithmetic (exact integer
    micro-units before the final scale). Used before binning so last-digit
    differences in cos/sin cannot move a value across a bin edge; cheaper than
    decimal rounding and written the same way in the SQL oracle."""
    return F.floor(v * 1e6 + 0.5)


def bin_of(v: F.Column, width: float | F.Column) -> F.Column:
    """Bin number ``floor(round6(v) / width)`` computed on micro-units."""
    return F.floor(round6(v) / (width * 1e6))


def hough_votes(
    points: DataFrame,
    run: str,
    x: str,
    y: str,
    side: F.Column | str = C.SIDE_FRONT,
    register: Sequence[str] = (),
    voting: F.Column | None = None,
    bins: int = C.THETA_BINS,
    r_bin: float = C.R_BIN,
) -> DataFrame:
    """Votes per (run, side, theta_bin, r_bin). Equal points are counted first and
    vote once with their count; the bin angles are constants, so no trig runs per
    row; ``r`` is rounded to 6 places before binning (``bin_of``). Points where
    ``voting`` does not hold do not vote; every run also gets one row without votes
    (bins null) on each side of ``register``, so no second scan finds the runs."""
    vote = F.lit(True) if voting is None else F.coalesce(voting, F.lit(False))
    own = side if isinstance(side, F.Column) else F.lit(side)

    def cell(on: F.Column, theta: F.Column, cos: F.Column, sin: F.Column) -> F.Column:
        return F.struct(on.alias("side"), theta.alias("theta_bin"), cos.alias("__cos"), sin.alias("__sin"))

    none = F.lit(None).cast("double")
    marks = F.array(*[cell(F.lit(s), F.lit(None).cast("int"), none, none) for s in register]).cast(
        "array<struct<side:string,theta_bin:int,__cos:double,__sin:double>>"
    )
    angles = F.array(*[
        cell(F.col("__own"), F.lit(k), F.lit(math.cos(k * math.pi / bins)), F.lit(math.sin(k * math.pi / bins)))
        for k in range(bins)
    ])
    r = F.col(x) * F.col("__cos") + F.col(y) * F.col("__sin")
    return (
        points.select(run, x, y, own.alias("__own"), vote.alias("__vote"))
        .groupBy(run, x, y, "__own", "__vote")
        .agg(F.count(F.lit(1)).alias("__w"))
        .select(run, x, y, "__w", F.inline(F.when(F.col("__vote"), F.concat(angles, marks)).otherwise(marks)))
        .groupBy(run, "side", "theta_bin", bin_of(r, r_bin).alias("r_bin"))
        .agg(F.sum(F.when(F.col("theta_bin").isNull(), F.lit(0)).otherwise(F.col("__w"))).alias("votes"))
    )


def _best_first(run: str) -> WindowSpec:
    return Window.partitionBy(run, "side").orderBy(F.col("votes").desc(), F.col("theta_bin"), F.col("r_bin"))


def detect_lines(points: DataFrame, run: str, x: str, y: str) -> DataFrame:
    """AGG-10: ``(run, line_no, theta_bin, r_bin, votes)``: every bin with at least
    MIN_VOTES votes is a line of its run, numbered from the best-voted on (ties:
    lower theta bin, then lower r bin)."""

    def work(p: DataFrame) -> DataFrame:
        lines = hough_votes(p, run, x, y).where(F.col("votes") >= C.MIN_VOTES)
        return lines.select(run, F.row_number().over(_best_first(run)).alias("line_no"), "theta_bin", "r_bin", "votes")

    return within_groups(points.select(run, x, y), run, work, C.THETA_BINS)


def summarize_runs(
    points: DataFrame,
    run: str,
    x: str,
    y: str,
    side: F.Column | str = C.SIDE_FRONT,
    sides: Sequence[str] = (C.SIDE_FRONT,),
    voting: F.Column | None = None,
    bins: int = C.THETA_BINS,
    r_bin: float = C.R_BIN,
    least_votes: int = C.MIN_VOTES,
) -> DataFrame:
    """AGG-4 + WIN-1 + SCL-13 in one pass over both sides: summary rows
    ``(run, qualifier, value)`` for every run of ``points`` and side of ``sides`` --
    ``<side>NO_yES`` (line count, 0 kept) and ``<side>y<k>`` =
    ``THETA:<theta_bin>,R:<r_bin>`` per line. ``side`` is the side a point votes on;
    points where ``voting`` does not hold only register their run.

    The vote-less row of a run and side becomes its count row: the window that
    numbers the lines also counts them, so lines stay rows, no list is gathered, and
    there is no join."""
    is_line = F.col("theta_bin").isNotNull()
    w = _best_first(run)  # the row without votes comes last
    name = F.when(is_line, F.concat(F.lit(C.Q_DETECTION), F.col("__k"))).otherwise(F.lit(C.Q_COUNT))
    value = F.when(is_line, line_text("theta_bin", "r_bin")).otherwise(F.col("__n"))
    own = side if isinstance(side, F.Column) else F.lit(side)
    vote = F.lit(True) if voting is None else voting

    def work(p: DataFrame) -> DataFrame:
        votes = hough_votes(p, run, x, y, F.col("__side"), sides, F.col("__voting"), bins, r_bin)
        ranked = votes.where((F.col("votes") >= least_votes) | ~is_line).select(
            "*", F.row_number().over(w).cast("string").alias("__k"), F.count("theta_bin").over(Window.partitionBy(run, "side")).cast("string").alias("__n")
        )
        return ranked.select(run, F.concat("side", name).alias("qualifier"), value.alias("value"))

    return within_groups(points.select(run, x, y, own.alias("__side"), vote.alias("__voting")), run, work, bins + len(sides))


def line_text(theta: str, r: str) -> F.Column:
    """SCL-13: a line's summary text."""
    return F.concat(F.lit(C.T_THETA), F.col(theta).cast("string"), F.lit(C.T_R), F.col(r).cast("string"))


def summary_entries(runs: DataFrame, lines: DataFrame, run: str, side: str = C.SIDE_FRONT) -> DataFrame:
    """Summary rows from a given runs table and a given lines table (any line
    source); ``summarize_runs`` is the one-pass form over points.

    Long rows ``(run, qualifier, value)``:
    ``<side>NO_yES`` = number of lines (0 kept for every run in ``runs``) and
    ``<side>y<k>`` = ``THETA:<theta_bin>,R:<r_bin>`` per line k.

    The count is one aggregate over run rows (0) unioned with line rows (1):
    no join back to the runs."""
    counts = (
        runs.select(run, F.lit(0).alias("__one"))
        .unionByName(lines.select(run, F.lit(1).alias("__one")))
        .groupBy(run)
        .agg(F.sum("__one").alias("__n"))
        .select(
            run,
            F.lit(side + C.Q_COUNT).alias("qualifier"),
            F.col("__n").cast("string").alias("value"),
        )
    )
    entries = lines.select(
        run,
        F.concat(F.lit(side + C.Q_DETECTION), F.col("line_no").cast("string")).alias("qualifier"),
        line_text("theta_bin", "r_bin").alias("value"),
    )
    return counts.unionByName(entries)


def side_writer_filter(qualifier: F.Column, side: str) -> F.Column:
    """FLT-12: the front writer keeps every summary entry; the back writer keeps
    only back entries (``By...`` and ``BNO_yES``)."""
    if side == C.SIDE_FRONT:
        return F.lit(True)
    return qualifier.contains(C.SIDE_BACK + C.Q_DETECTION) | qualifier.contains(C.SIDE_BACK + C.Q_COUNT)


def pattern_table_filter(qualifier: F.Column, side: str) -> F.Column:
    """FLT-13: summary entries the pattern-table writer keeps for ``side``:
    qualifiers containing ``<side>y`` or ``<side>NO_y``. For the front side
    (empty prefix) the reference's test keeps any qualifier with a ``y``, back
    entries included (Q13); here the side is matched exactly instead."""
    if side == C.SIDE_FRONT:
        return ~qualifier.startswith(C.SIDE_BACK) & (
            qualifier.startswith(C.Q_DETECTION) | qualifier.startswith(C.Q_COUNT_START)
        )
    return qualifier.contains(side + C.Q_DETECTION) | qualifier.contains(side + C.Q_COUNT_START)


def is_count_qualifier(qualifier: F.Column, side: str) -> F.Column:
    """SCL-10: whole-string match of the count qualifier (``matches``)."""
    return qualifier.rlike("^" + side + C.Q_COUNT + "$")


def info_keys_filter(qualifier: F.Column) -> F.Column:
    """FLT-13: header entries copied into the pattern table."""
    out = F.lit(False)
    for k in C.INFO_KEYS_FOR_PATTERN:
        out = out | qualifier.contains(k)
    return out


def density_grid(points: DataFrame, run: str, x: str, y: str, gx: float = C.GRID_X, gy: float = C.GRID_Y) -> DataFrame:
    """AGG-11: points per run and 2-D cell (the picture of a run, as counts)."""
    return (
        points.select(
            run,
            bin_of(F.col(x), gx).alias("gx"),
            bin_of(F.col(y), gy).alias("gy"),
        )
        .groupBy(run, "gx", "gy")
        .agg(F.count(F.lit(1)).alias("n_points"))
    )


# ---- peaks of the vote grid, parameter sets, pictures at several resolutions ------


def line_peaks(points: DataFrame, run: str, x: str, y: str, bins: int = C.THETA_BINS) -> DataFrame:
    """AGG-10, one physical line as one detection: ``(run, peak_no, theta_bin, r_bin, votes)``, the bins
    with at least MIN_VOTES votes that no neighbour beats. Neighbours are up to one bin away
    in angle and radius; past the last angle comes the first again with the radius' sign changed
    (bin b is then -b-1). A neighbour beats a bin by more votes or, with as many, by the lower angle
    bin, then the lower radius bin.

    No join: every bin sends its votes to itself and its eight neighbours, and the greatest that
    arrives at a bin is its own where it is a peak -- one combining aggregate."""
    sent = []
    for dt in (-1, 0, 1):
        theta = F.col("theta_bin") + dt
        over = (theta < 0) | (theta >= bins)
        for dr in (-1, 0, 1):
            r = F.when(over, -F.col("r_bin") - 1).otherwise(F.col("r_bin")) + dr
            sent.append(F.struct(F.pmod(theta, F.lit(bins)).alias("to_theta"), r.alias("to_r")))
    rank = F.struct("votes", (-F.col("theta_bin")).alias("t"), (-F.col("r_bin")).alias("r"))
    w = Window.partitionBy(run).orderBy(F.col("votes").desc(), "theta_bin", "r_bin")

    def work(p: DataFrame) -> DataFrame:
        cells = hough_votes(p, run, x, y, bins=bins).where(F.col("votes") >= C.MIN_VOTES)
        arrived = cells.select(run, rank.alias("rank"), F.inline(F.array(*sent)))
        best = arrived.groupBy(run, "to_theta", "to_r").agg(F.max("rank").alias("best"))
        peak = best.where((F.col("best.t") == -F.col("to_theta")) & (F.col("best.r") == -F.col("to_r")))
        named = peak.select(run, F.col("to_theta").cast("int").alias("theta_bin"), F.col("to_r").alias("r_bin"), F.col("best.votes").alias("votes"))
        return named.select(run, F.row_number().over(w).alias("peak_no"), "theta_bin", "r_bin", "votes")

    return within_groups(points.select(run, x, y), run, work, bins)


def profile_table(properties: DataFrame) -> DataFrame:
    """SRC-6 for detection: one row a parameter set, ``(profile, angles, r_bin, least_votes, offset)``, from
    its ``key=value`` rows; a set without one of the keys has its default."""

    def of(key: str, kind: str, default: float) -> F.Column:
        value = F.max(F.when(F.col("key") == key, F.col("value")))
        return F.coalesce(value.try_cast(kind), F.lit(default).cast(kind)).alias(key)

    return properties.groupBy("profile").agg(of("angles", "int", C.THETA_BINS), of("r_bin", "double", C.R_BIN), of("least_votes", "bigint", C.MIN_VOTES), of("offset", "double", C.OFF))


def profile_lines(points: DataFrame, profiles: DataFrame, run: str, x: str, y: str) -> DataFrame:
    """AGG-10 under every parameter set: ``(profile, run, line_no, theta_bin, r_bin, votes)``. Angle count,
    radius bin and least votes come from the rows of ``profiles``: their angles make one small table, which
    every distinct point meets as an array (a scalar subquery), so the votes are exploded from data. Work and rows grow with
    the sum of the sets' angle counts."""
    theta = F.col("k") * F.lit(math.pi) / F.col("angles")
    angles = profiles.select("profile", "angles", "r_bin", "least_votes", F.explode(F.sequence(F.lit(0), F.col("angles") - 1)).alias("k"))
    entry = F.struct("profile", F.col("k").alias("theta_bin"), F.cos(theta).alias("__cos"), F.sin(theta).alias("__sin"), F.col("r_bin").alias("__width"), "least_votes")
    table = angles.agg(F.collect_list(entry).alias("a"))  # as many entries as the sets have angles
    votes_each = angles.count()
    r = F.col(x) * F.col("__cos") + F.col(y) * F.col("__sin")
    w = Window.partitionBy("profile", run).orderBy(F.col("votes").desc(), "theta_bin", "r_bin")

    def work(p: DataFrame) -> DataFrame:
        distinct = p.groupBy(run, x, y).agg(F.count(F.lit(1)).alias("__w"))
        votes = (
            distinct.select(run, x, y, "__w", table.scalar().alias("__a")).select(run, x, y, "__w", F.inline("__a"))
            .groupBy("profile", run, "theta_bin", "least_votes", bin_of(r, F.col("__width")).alias("r_bin"))
            .agg(F.sum("__w").alias("votes"))
            .where(F.col("votes") >= F.col("least_votes"))
        )
        return votes.select("profile", run, F.row_number().over(w).alias("line_no"), "theta_bin", "r_bin", "votes")

    return within_groups(points.select(run, x, y), run, work, max(1, votes_each))


Z_BITS = 16  # bits of a cell number on each axis


def z_order(gx: F.Column, gy: F.Column, bits: int = Z_BITS) -> F.Column:
    """The cell's place on the Z-order curve: the bits of both numbers in turn (x the lower)."""

    def spread(v: F.Column) -> F.Column:
        v = v.bitwiseAND(F.lit((1 << bits) - 1))
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(gx.cast("bigint")).bitwiseOR(F.shiftleft(spread(gy.cast("bigint")), 1))


def density_levels(points: DataFrame, run: str, x: str, y: str, gx: float, gy: float, levels: int) -> DataFrame:
    """AGG-11 at several resolutions: ``(run, level, cell, n_points)``. Level 0 has cells of ``gx`` by ``gy``; a
    cell of the next level is four of the last, whose Z-order numbers are its own number and two bits more, so
    points are counted once, in the finest cells, and these counts are rolled up by their numbers'
    leading bits in one combining aggregate. Cell numbers are taken modulo 2^16 on each axis."""
    up = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("cell", 2 * k).alias("at")) for k in range(levels)])

    def work(p: DataFrame) -> DataFrame:
        finest = p.groupBy(run, "cell").agg(F.count(F.lit(1)).alias("n_points"))
        return finest.select(run, "n_points", F.inline(up)).groupBy(run, "level", F.col("at").alias("cell")).agg(F.sum("n_points").alias("n_points"))

    return within_groups(points.select(run, z_order(bin_of(F.col(x), gx), bin_of(F.col(y), gy)).alias("cell")), run, work, levels)
