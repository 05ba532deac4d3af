"""Gates, flags and side routing as column expressions.

The reference ends a file at the first failing check and prints why; here every
run keeps its row and gets the name of the first check that fired (null when
clean), so rejects stay queryable and nothing is thrown for a data fault.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from notchline import constants as C


def first_reason(checks: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first check (in order) whose predicate holds; a null predicate
    counts as not firing. Null when none fires."""
    out = None
    for name, pred in checks:
        cond = F.coalesce(pred, F.lit(False))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def reference_checks(header: Column, version: Column, n_points: Column, flat: Column, maxpoint: int):
    """The reference's gate order (FLT-2..FLT-8) over a header map column.
    ``flat`` is the looked-up flat position (null when no reference row)."""
    h = lambda k: F.element_at(header, F.lit(k))
    device = h("DeviceID")
    return [
        (
            "excluded_type",
            (version == C.DIALECT_NEW)
            & ((h("domainType") == C.EXCLUDED_TYPE) | (h("DiePitchX") == C.EXCLUDED_PITCH)),
        ),
        ("placeholder", (version == C.DIALECT_OLD) & (h("domainarge") == C.PLACEHOLDER_VALUE)),
        ("missing_device", device.isNull()),
        ("bad_id_length", F.coalesce(F.length(h("imageID")), F.lit(-1)) != C.IMAGE_ID_LENGTH),
        ("too_many_points", n_points > maxpoint),
        ("no_flat_position", F.coalesce(flat_position(device, flat), F.lit(-1)) < 0),
    ]


def flat_position(device: Column, looked_up: Column) -> Column:
    """FLT-8: device ``None`` (and ``BARE``) -> 0, else the reference's value
    (null when the device has no reference row)."""
    return F.when(device.isin(C.DEVICE_NONE, C.DEVICE_BARE), F.lit(0)).otherwise(looked_up)


def contains_any(text: Column, codes: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in codes:
        out = out | text.contains(c)
    return out


def contains_none(text: Column, codes: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in codes:
        out = out & ~text.contains(c)
    return out


def eligibility_flag(
    station: Column,
    class_sum: Column,
    special: Sequence[str] = (C.SPECIAL_CODE,),
    production: Sequence[str] = C.PRODUCTION_CODES,
    mac: Sequence[str] = (C.MAC_CODE,),
) -> Column:
    """FLT-9 in the reference's order: special code -> eligible; else a production
    code -> eligible; else not. Then a run with classified points (sum of
    |class| > 0) on a station without the MAC code is not eligible, special or not."""
    base = F.when(contains_any(station, special), F.lit(True)).when(
        contains_any(station, production), F.lit(True)
    ).otherwise(F.lit(False))
    demote = (class_sum > 0) & contains_none(station, mac)
    return F.when(F.coalesce(demote, F.lit(False)), F.lit(False)).otherwise(
        F.coalesce(base, F.lit(False))
    )


def station_tag(
    station: Column,
    type_text: Column,
    absent: Sequence[str] = C.TAG_ABSENT,
    present: Sequence[str] = C.TAG_PRESENT,
    type_code: str = C.TAG_TYPE,
) -> Column:
    """FLT-7: ``(none of absent and all of present) or type contains type_code``;
    a tag only, it drops nothing."""
    allp = F.lit(True)
    for c in present:
        allp = allp & station.contains(c)
    return F.coalesce(
        (contains_none(station, absent) & allp) | type_text.contains(type_code), F.lit(False)
    )


def two_sided(station: Column, code: str = C.TWO_SIDED_CODE) -> Column:
    """CTL-1: stations with the two-sided code analyse front and back apart."""
    return F.coalesce(station.contains(code), F.lit(False))


def point_side(is_two_sided: Column, is_back: Column) -> Column:
    """Side of a point: back only on two-sided stations, else everything is front."""
    return F.when(is_two_sided & is_back, F.lit(C.SIDE_BACK)).otherwise(F.lit(C.SIDE_FRONT))
