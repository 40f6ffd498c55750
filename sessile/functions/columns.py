"""Column expressions over profiles, pixel arrays and angles.

Arrays are row-local, so nothing here shuffles; indexes count from 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def stretched(profile: Column, n: int) -> Column:
    """Each element ``n div size`` times, cut at ``n``."""
    times = F.greatest(F.lit(0), F.floor(F.lit(n) / F.greatest(F.size(profile), F.lit(1)))).cast("int")
    return F.slice(F.flatten(F.transform(profile, lambda v: F.array_repeat(v, times))), F.lit(1), F.lit(n))


def advancing_angle(dy: Column, dx: Column) -> Column:
    """90 less the degrees of atan(dy / dx); a vertical tangent counts as +-90, no tangent at all as null."""
    return 90 - _slope_degrees(dy, dx)


def receding_angle(dy: Column, dx: Column) -> Column:
    return 90 + _slope_degrees(dy, dx)


def _slope_degrees(dy: Column, dx: Column) -> Column:
    return F.when((dx == 0) & (dy == 0), F.lit(None).cast("double")).when(dx == 0, 90.0 * F.signum(dy)).otherwise(F.degrees(F.atan(dy / dx)))


def middle_angle(dy: Column, dx: Column) -> Column:
    """Angle of the middle line by its last two samples: -h where x falls, else 270 - h."""
    h = _slope_degrees(dy, dx)
    return F.when(dx < 0, -h).otherwise(270 - h)


def fit_window(angle: Column, ratio: float = 1.0) -> Column:
    """Pixels and polynomial degree that suit an angle; null for a null or NaN angle."""
    choice = lambda px, degree: F.struct(F.lit(int(px * ratio)).alias("pixels"), F.lit(degree).alias("degree"))
    return F.when(angle.isNull() | F.isnan(angle), F.lit(None)).when(angle <= 60, choice(60, 2)).when(angle <= 105, choice(85, 2)).when(angle <= 135, choice(125, 3)).otherwise(choice(145, 4))


def luma(red: Column, green: Column, blue: Column) -> Column:
    return F.floor(0.299 * red + 0.587 * green + 0.114 * blue + 0.5).cast("int")
