"""Inspection-file text to rows: header fields and listed points.

A file is lines. ``Field <name> <n> {"v1", ...}`` lines are its header; a line
``List <name> <n> { C1 C2 ... }`` opens a block whose lines are rows with these columns,
until a line ``EndOfList`` or the next block. The reference's parser walks a file line
by line and remembers the block it is in. Here the text is cut where a block
opens, and the pieces are exploded to lines: each line comes out beside the
header of its own piece -- the last block header before it -- so no line waits for
another, nothing is shuffled, and a text is read once.

The header stays one value a file, a map; lines of lists keep their place ``(block, pos)``, so "a
later line wins" is a combining aggregate afterwards (``keep_last``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.text import dialect, dialect_scale, first_lines_text, java_trim, render_named, with_header

_OPEN = r"^List\s+(\w+)"
_NAMES = r"\{([^}]*)\}"

KIND_FILE, KIND_POINT = "file", "point"


def block_lines(files: DataFrame, text: str) -> DataFrame:
    """``files`` (without ``text``) with one row a line: ``block`` (number of the piece, 0 before the
    first list), ``list`` and ``names`` (the open list and its columns; null outside one), ``pos``
    and ``line``. The opening and closing lines of a list are left out. A null text gives no row."""
    keep = [c for c in files.columns if c != text]
    pieces = files.select(*keep, F.posexplode(F.split(F.col(text), r"\r?\n(?=List\s)")).alias("block", "__piece"))
    split = pieces.select(*keep, "block", F.split("__piece", r"\r?\n").alias("__lines"))
    head = F.get("__lines", F.lit(0))
    opened = F.regexp_extract(head, _OPEN, 1)
    named = split.select(
        *keep, "block", "__lines",
        F.when(opened != "", opened).alias("__list"),
        F.split(java_trim(F.regexp_extract(head, _NAMES, 1)), r"\s+").alias("__names"),
        F.array_position("__lines", C.END_OF_LIST).alias("__end"),  # 1-based, 0 without one
    )
    lines = named.select(*keep, "block", "__list", "__names", "__end", F.posexplode("__lines").alias("pos", "line"))
    inside = F.col("__list").isNotNull() & ((F.col("__end") == 0) | (F.col("pos") < F.col("__end") - 1))
    edge = F.col("__list").isNotNull() & ((F.col("pos") == 0) | (F.col("pos") == F.col("__end") - 1))
    return lines.where(~edge).select(
        *keep, "block", F.when(inside, F.col("__list")).alias("list"), F.when(inside, F.col("__names")).alias("names"), "pos", "line"
    )


def column_of(names: Column, fields: Column, name: str) -> Column:
    """The field that stands under column ``name`` of the list; null without it."""
    at = F.array_position(names, name).cast("int")
    return F.when(at > 0, F.get(fields, at - 1))


def line_cap(version: Column) -> Column:
    """SRT-2: how many lines of a file are read, by dialect."""
    return F.when(version == C.DIALECT_NEW, F.lit(C.LINE_CAP_NEW)).otherwise(F.lit(C.LINE_CAP_OLD))


def parse_files(files: DataFrame, key: str, text: str, points: str = C.POINT_LIST) -> DataFrame:
    """SCL-17, FLT-6, SNK-3: the rows of every file's text, each text read once.

    Output ``(key, version, kind, header, block, pos, name, value, x, y, flag)``:

    * kind ``file``: one row a file (also for a null or empty text), with its dialect and its
      header map;
    * kind ``point``: a line of the list ``points``, split into as many fields as the list
      has columns (the last takes the rest): ``name`` is ``point<first field>``, ``value`` its ``column:field`` pairs,
      ``x`` and ``y`` the numbers under ``X`` and ``Y`` times the dialect's scale (null where
      they are no numbers) and ``flag`` the text under ``FLAG``.

    Lines past the dialect's cap are not read. Repeated point ids are all there, in order."""
    version = dialect(F.col(text))
    # the marker line opens the cut text, so that every file has a row of its own
    capped = F.concat(F.lit(C.FILE_MARK + "\n"), F.coalesce(first_lines_text(F.col(text), line_cap(version)), F.lit("")))
    cut = with_header(files.select(F.col(key), version.alias("version"), capped.alias("__text")), "__text")
    lines = block_lines(cut, "__text")
    is_file = (F.col("block") == 0) & (F.col("pos") == 0)
    is_point = (F.col("list") == points) & (java_trim(F.col("line")) != "")
    parsed = lines.where(is_file | is_point).select(
        key, "version", "block", "pos", "names",
        F.when(is_file, F.lit(KIND_FILE)).otherwise(F.lit(KIND_POINT)).alias("kind"),
        F.when(is_file, F.col("header")).alias("header"),
        F.when(is_point, F.split(java_trim(F.col("line")), r"\s+", F.size("names"))).alias("__fields"),
    )
    fields, names = F.col("__fields"), F.col("names")
    scale = dialect_scale(F.col("version"))

    def number(name: str) -> Column:
        # in whole millionths, so that 0.017 thousands are 17 and not a digit off
        return F.floor(column_of(names, fields, name).try_cast("double") * scale * 1e6 + 0.5) / 1e6

    return parsed.select(
        key, "version", "kind", "header", "block", "pos",
        F.concat(F.lit(C.Q_POINT), F.get(fields, F.lit(0))).alias("name"), render_named(names, fields).alias("value"),
        number("X").alias("x"), number("Y").alias("y"), column_of(names, fields, "FLAG").alias("flag"),
    )


def run_facts(parsed: DataFrame, key: str, cls: Column, back: Column) -> DataFrame:
    """One row a file from its parsed rows: ``version``, ``header``, the number of points ``n_all`` and
    ``n_back``, and the sums of ``cls`` over all and over front points (``j_all``, ``j_front``). Points are counted by
    a combining aggregate of numbers before they meet the files."""
    stats = parsed.where(F.col("kind") == KIND_POINT).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(back, F.lit(1))).alias("n_back"),
        F.sum(cls).cast("bigint").alias("j_all"),
        F.sum(F.when(~back, cls)).cast("bigint").alias("j_front"),
    )
    files = parsed.where(F.col("kind") == KIND_FILE).select(key, "version", "header")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_all", "n_back", "j_all", "j_front")]
    return files.join(stats, key, "left").select(key, "version", "header", *counts)
