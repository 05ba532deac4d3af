"""String column helpers with the reference's (Java) text semantics."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notchline import constants as C

# Java's String.trim removes every char <= U+0020 from both ends.
_JAVA_BLANKS = "".join(chr(i) for i in range(0x21))


def java_trim(s: Column) -> Column:
    return F.btrim(s, F.lit(_JAVA_BLANKS))


def java_split(s: Column, sep: str) -> Column:
    """``String.split(sep)`` for a literal separator: Spark keeps trailing empty
    fields, Java drops them, so trailing separators are stripped first."""
    q = re.escape(sep)
    return F.split(F.regexp_replace(s, f"(?:{q})+$", ""), q)


def field(arr: Column, i: int) -> Column:
    """0-based positional access; null when the array is shorter (no error under ANSI)."""
    return F.get(arr, i)


def dialect(text: Column, marker: str = C.DIALECT_MARKER) -> Column:
    """FLT-1: the newer dialect when the text contains the marker."""
    return F.when(text.contains(marker), F.lit(C.DIALECT_NEW)).otherwise(F.lit(C.DIALECT_OLD))


def dialect_scale(version: Column) -> Column:
    """PRJ-6: coordinate scale per dialect."""
    return F.when(version == C.DIALECT_NEW, F.lit(C.SCALE_NEW)).otherwise(F.lit(C.SCALE_OLD))


def first_lines(text: Column, n: int | Column) -> Column:
    """SRT-2: the first ``n`` lines of a text as an array (the whole text is split,
    so the line count stays available beside it). ``n`` may differ by row."""
    return F.slice(F.split(text, "\n"), F.lit(1), n if isinstance(n, Column) else F.lit(n))


def first_lines_text(text: Column, n: Column) -> Column:
    """The first ``n`` lines of a text as text."""
    return F.call_function("substring_index", text, F.lit("\n"), n)


def point_fields(text: Column, n: int) -> Column:
    """SCL-3: a whitespace-separated point split on runs of blanks into at most
    ``n`` fields; the last keeps the rest."""
    return F.split(java_trim(text), r"\s+", n)


def render_fields(parts: Column, names: Sequence[str]) -> Column:
    """SCL-14: ``name:value`` pairs joined by commas. The names are fixed, so each
    pair is a plain positional expression (codegen, no lambda); a name past the
    last field pairs with null and ``concat_ws`` skips it."""
    return F.concat_ws(",", *[F.concat(F.lit(f"{n}:"), F.get(parts, i)) for i, n in enumerate(names)])


def render_named(names: Column, fields: Column) -> Column:
    """SCL-14 with names out of the data: ``name:value`` pairs joined by commas, as many as there are fields."""
    pairs = F.zip_with(F.slice(names, F.lit(1), F.size(fields)), fields, lambda n, v: F.concat(n, F.lit(":"), v))
    return F.array_join(pairs, ",")


def render_point(text: Column, names: Sequence[str]) -> Column:
    return render_fields(point_fields(text, len(names)), names)


def point_key(text: Column) -> Column:
    """Qualifier of a point: ``point`` + its first field."""
    return key_of_fields(point_fields(text, 2))


def key_of_fields(parts: Column) -> Column:
    return F.concat(F.lit(C.Q_POINT), F.get(parts, 0))


def yyyymmdd(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


# A header line: Field <name> <count> {"v1", "v2", ...}
_FIELD_LINE = r'(?m)^[ \t]*Field[ \t]+(\w+)[ \t]+\d+[ \t]+\{([^}]*)\}'
_QUOTED = r'"([^"]*)"'
# A list from its opening line to its end, to the next list or to the end of the text.
_LIST = rf"(?ms)^List\s.*?(?:^{C.END_OF_LIST}[ \t]*\r?$|(?=^List\s)|\z)"


def with_header(df: DataFrame, text: str, out: str = "header", pick: int = -1) -> DataFrame:
    """SCL-17: ``df`` with the header of ``text`` as ``map<string,string>`` column ``out``: the
    ``Field <name> <n> {"..", ..}`` lines outside lists, name -> one of its values (``pick``: 1-based
    position, negative from the end; lines without any value are left out). A
    repeated name keeps its last line (map put semantics). The station field's second
    value of three is the equipment type, which the map holds as ``domainType``. A null text has a null map.

    Names and values are two passes over the text outside lists; a name's last line is the
    first of the lines in reverse."""
    fields = df.withColumn("__header", F.regexp_replace(text, _LIST, ""))
    lines = fields.withColumn("__names", F.reverse(F.regexp_extract_all("__header", F.lit(_FIELD_LINE), F.lit(1)))).withColumn(
        "__values", F.transform(F.reverse(F.regexp_extract_all("__header", F.lit(_FIELD_LINE), F.lit(2))), lambda b: F.regexp_extract_all(b, F.lit(_QUOTED), F.lit(1)))
    )

    def extended(name: Column, values: Column) -> Column:
        """The line's entry, and that of the type."""
        own = F.struct(name.alias("name"), F.try_element_at(values, F.lit(pick)).alias("value"))
        kind = F.struct(F.lit(C.TYPE_FIELD).alias("name"), F.get(values, F.lit(1)).alias("value"))
        none = F.array().cast("array<struct<name:string,value:string>>")
        station = (name == C.STATION_FIELD) & (F.size(values) == 3)
        return F.when(F.size(values) == 0, none).when(station, F.array(kind, own)).otherwise(F.array(own))

    entries = lines.withColumn("__entries", F.flatten(F.zip_with("__names", "__values", extended)))
    named = entries.withColumn("__all", F.col("__entries.name")).withColumn("__once", F.array_distinct("__all"))
    last = F.transform("__once", lambda n: F.get(F.col("__entries"), F.array_position("__all", n).cast("int") - 1)["value"])
    return named.withColumn(out, F.map_from_arrays("__once", last)).drop("__header", "__names", "__values", "__entries", "__all", "__once")
