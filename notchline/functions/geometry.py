"""Column expressions for angles, rotations and line parameters."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from notchline import constants as C


def pi() -> Column:
    return F.lit(math.pi)


def rotation_free(rot: Column) -> Column:
    """An arm without a usable rotation matches any angle (absent, or the
    "no rotation" sentinel, which is above the free threshold)."""
    return rot.isNull() | (rot > C.FREE_ROTATION_ABOVE)


def angle_direct(rot: Column, theta: Column, tol: float = C.ANG) -> Column:
    return F.abs(rot / 180.0 * pi() - theta) < tol


def angle_opposite(rot: Column, theta: Column, tol: float = C.ANG) -> Column:
    """The opposite direction: rotation folded into (-180, 180] and turned by pi.
    Angles are not wrapped at 0 / 2*pi, as in the reference."""
    folded = F.when(rot >= 180.0, rot - 360.0).otherwise(rot)
    return F.abs(folded / 180.0 * pi() + pi() - theta) < tol


def angle_ok(rot: Column, theta: Column, tol: float = C.ANG) -> Column:
    """JON-6: free rotation, or within ``tol`` radians of it or of its opposite."""
    return rotation_free(rot) | angle_direct(rot, theta, tol) | angle_opposite(rot, theta, tol)


def rotate_grid(x: Column, y: Column, flat: Column) -> tuple[Column, Column]:
    """Rotate integer grid coordinates by the flat position (0/90/180/270 degrees,
    counter-clockwise). Any other value leaves them unchanged."""
    gx = (
        F.when(flat == 90, -y)
        .when(flat == 180, -x)
        .when(flat == 270, y)
        .otherwise(x)
    )
    gy = (
        F.when(flat == 90, x)
        .when(flat == 180, -y)
        .when(flat == 270, -x)
        .otherwise(y)
    )
    return gx, gy
