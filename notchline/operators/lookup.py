"""Lookups: first match by order, substring (contains) joins, prefix joins.

The reference scans a lookup file line by line per inspected file and stops at
the first line that contains the key. Here the lookup runs once for all keys:

* ``first_by`` keeps the first row per key by an ordering, as an aggregate
  (``min`` of a struct), so it combines map-side and never gathers a key's rows
  into one task;
* ``substring_join`` finds every (needle, haystack) pair where the haystack
  text contains the needle, exactly, through an equi-join on pieces of the
  needle, followed by the real ``contains`` check. No nested-loop or cartesian join is
  planned; candidate pairs are only the haystack rows sharing a piece. Needles of 7 characters or
  more are met at pieces of 5 characters cut at every third place of the haystack: wherever
  such a needle stands, one of its first three pieces is among them. A shorter
  needle is met at one gram, its rarest one in the haystack.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 3
STEP, PIECE = 3, 5  # pieces of the haystack: one at every STEP-th place
LONG = STEP - 1 + PIECE  # a needle as long holds a whole piece wherever it stands
#: Up to so many different needles, the table of their pieces (three each) is broadcast; more are joined by a shuffle.
BROADCAST_NEEDLES = 200_000


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the payload of the row smallest in ``order``
    (ties broken by the payload columns themselves, so the choice is total)."""
    m = F.min(F.struct(*[F.col(c) for c in (*order, *payload)])).alias("__first")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"__first.{c}").alias(c) for c in (*order, *payload)])


def _grams(s: Column, k: int) -> Column:
    """All substrings of length ``k``; none when shorter. A look-ahead finds them in one pass."""
    return F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def substring_join(
    needles: DataFrame,
    hay: DataFrame,
    needle_col: str,
    hay_col: str,
    q: int = Q,
) -> DataFrame:
    """All pairs of ``needles`` x ``hay`` rows with ``hay_col`` containing
    ``needle_col`` (case-sensitive). Empty or null needles match nothing.

    Long needles are routed by their first pieces (see above). Of the others, each of length
    >= q is routed by its rarest q-gram (frequency counted over the haystack), a shorter one
    by itself against the haystack's grams of its own length. Column names of the two
    sides must not collide.
    """
    n = F.col(needle_col)
    distinct = needles.select(n.alias("__needle")).where(
        F.col("__needle").isNotNull() & (F.length("__needle") > 0)
    ).distinct()
    # how many needles there are of each length below LONG, and of the others: 7 rows
    sizes = {r.k: r.n for r in distinct.groupBy(F.least(F.length("__needle"), F.lit(LONG)).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    few = sum(sizes.values()) <= BROADCAST_NEEDLES

    def pieces(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    # pieces go with a hash of the line, not with the line: a line is fetched only once for a needle
    # that may be in it (lines of one hash all come back, and the contains test decides)
    keyed = hay.withColumn("__line", F.xxhash64(hay_col))
    found = distinct.select("__needle", F.lit(0).cast("bigint").alias("__line")).limit(0)
    if LONG in sizes:
        firsts = F.array(*[F.substring("__needle", 1 + i, PIECE) for i in range(STEP)])
        own = distinct.where(F.length("__needle") >= LONG).select("__needle", F.explode(F.array_distinct(firsts)).alias("__g"))
        cut = F.regexp_extract_all(F.col(hay_col), F.lit(f"(?s)(?=(.{{{PIECE}}})).{{{STEP}}}"), F.lit(1))
        found = keyed.select("__line", F.explode(cut).alias("__g")).join(pieces(own), "__g").select("__needle", "__line").distinct()
    short = sorted(k for k in sizes if k < LONG)
    if short:
        ng = distinct.where(F.length("__needle") < LONG).select("__needle", F.explode(candidate_grams_of(F.col("__needle"), q)).alias("__g"))
        every = F.flatten(F.array(*[_grams(F.col(hay_col), k) for k in sorted({min(k, q) for k in short})]))
        grams = keyed.select("__line", F.explode(F.array_distinct(every)).alias("__g"))
        freq = grams.join(pieces(ng.select("__g").distinct()), "__g", "left_semi").groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
        # choose one gram per distinct needle value, then route the needle by it
        # grams absent from the haystack count 0: the needle can match nothing then
        chosen = (
            ng.join(freq, "__g", "left")
            .groupBy("__needle")
            .agg(F.min_by("__g", F.struct(F.coalesce(F.col("__n"), F.lit(0)), F.col("__g"))).alias("__g"))
        )
        found = found.unionByName(grams.join(pieces(chosen), "__g").select("__needle", "__line").distinct())
    return (
        needles.join(found, n == found["__needle"])
        .join(keyed, "__line")
        .where(F.col(hay_col).contains(F.col(needle_col)))
        .drop("__needle", "__line")
    )


def candidate_grams_of(n: Column, q: int = Q) -> Column:
    """Routing grams of a needle: its q-grams, or itself when shorter than q. Grams of
    different lengths differ, so lengths need no tag."""
    return F.when(F.length(n) >= q, _grams(n, q)).otherwise(F.array(n))


def prefix_join(
    ids: DataFrame,
    index: DataFrame,
    id_col: str,
    key_col: str,
    cut: int | str,
    how: str = "inner",
) -> DataFrame:
    """SRC-7 / JON-2: index rows whose key starts with the id. ``cut`` says where the id
    ends in the key: a separator (ids may have any length and hold none), or a
    length where a gate has made all ids that long (the reference's image ids). The
    prefix is an equi-key, so this is a hash or sort-merge join, not a range scan per id."""
    key = index[key_col]
    prefix = F.substring(key, 1, cut) if isinstance(cut, int) else F.substring_index(key, cut, 1)
    return ids.join(index, prefix == ids[id_col], how)


def lookup_first_line(
    runs: DataFrame,
    key_col: str,
    lines: DataFrame,
    line_col: str,
    order: Sequence[str],
    payload: Sequence[str],
) -> DataFrame:
    """JON-1 / FLT-8 as one step: for each run, the payload of the first reference
    line (by ``order``) whose text contains the run's key. Distinct keys are looked
    up once (``substring_join`` + ``first_by``) and the answer is joined back to
    the runs by equality, so a busy key costs one lookup. Runs whose key is found
    nowhere keep null payload columns."""
    keys = runs.select(F.col(key_col).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    hits = substring_join(keys, lines, "__key", line_col)
    first = first_by(hits, ["__key"], list(order), list(payload)).drop(*order)
    return runs.join(first, runs[key_col] == first["__key"], "left").drop("__key")
