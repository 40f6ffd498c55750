"""Curve fits and contact angles as aggregates over edge points."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import atan, degrees

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessile.functions import contour, kernels
from sessile.functions.columns import advancing_angle, middle_angle, receding_angle
from sessile.operators.arrow import of_points, with_kernel

FRAME = ["run_id", "frame_no"]


def line_fit(points: DataFrame, x: str, y: str, key: list[str] = FRAME) -> DataFrame:
    """``key, n, slope, intercept`` of the least-squares line; null slope for fewer than two distinct x."""
    return points.groupBy(*key).agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def parabola_fit(points: DataFrame, x: str, y: str, key: list[str] = FRAME) -> DataFrame:
    """``key, n, x0, c0, c1, c2``: y = c0 + c1 (x - x0) + c2 (x - x0)^2 with x0 the mean of x, by power sums.

    Null coefficients for fewer than three distinct x.
    """
    x0 = points.groupBy(*key).agg(F.avg(x).alias("x0"))
    u = F.col(x) - F.col("x0")
    sums = points.join(x0, key).groupBy(*key).agg(
        F.count("*").alias("n"), F.first("x0").alias("x0"), *[F.sum(u**p).alias(f"s{p}") for p in (2, 3, 4)], *[F.sum(F.col(y) * u**p).alias(f"t{p}") for p in (0, 1, 2)]
    )
    # The sum of u is 0, which leaves this much of Cramer's rule.
    n, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("n", "s2", "s3", "s4", "t0", "t1", "t2"))
    det = n * s2 * s4 - n * s3 * s3 - s2 * s2 * s2
    solved = F.abs(det) > 1e-9 * n * s2 * s4
    return sums.select(
        *key,
        "n",
        "x0",
        F.when(solved, (t0 * (s2 * s4 - s3 * s3) + t1 * s2 * s3 - t2 * s2 * s2) / det).alias("c0"),
        F.when(solved, (t0 * s2 * s3 + t1 * (n * s4 - s2 * s2) - t2 * n * s3) / det).alias("c1"),
        F.when(solved, (t2 * n * s2 - t0 * s2 * s2 - t1 * n * s3) / det).alias("c2"),
    )


def polynomial_fit(points: DataFrame, x: str, y: str, degree: int = 3, n: int = 100) -> DataFrame:
    """``run_id, frame_no, coef, xs, ys``: a fit of any degree around the mean of x, and n samples over the range of x; null for too few distinct x."""

    def kernel(x: np.ndarray, y: np.ndarray) -> tuple | None:
        order = np.lexsort((y, x))
        x, y = x[order].astype(float), y[order].astype(float)
        if len(np.unique(x)) <= degree:
            return None
        shift = x.mean()
        coef = np.polyfit(x - shift, y, degree)
        xs = np.linspace(x.min(), x.max(), n)
        return coef, xs, np.polyval(coef, xs - shift)

    return of_points(points, kernel, "coef array<double>, xs array<double>, ys array<double>", x, y)


def contact_angles(points: DataFrame, n: int) -> DataFrame:
    """Angles of lines through the ``n`` points nearest to each contact point, axes swapped as at a steep drop.

    ``run_id, frame_no, adv, rec, left_point, right_point``.  The line gives i
    as a function of j, so dy / dx of the drop is 1 / slope.
    """
    from sessile.operators.edges import nearest

    def side(name: str) -> DataFrame:
        return line_fit(nearest(points, n, name), "j", "i")

    left, right = side("advancing"), side("receding")
    a = left.select(*FRAME, F.col("slope").alias("ls"), F.col("intercept").alias("left_point"))
    b = right.select(*FRAME, F.col("slope").alias("rs"), F.col("intercept").alias("right_point"))
    return a.join(b, FRAME).select(*FRAME, advancing_angle(F.col("ls"), F.lit(1.0)).alias("adv"), receding_angle(F.col("rs"), F.lit(1.0)).alias("rec"), "left_point", "right_point")


def middle_line(points: DataFrame) -> DataFrame:
    """``run_id, frame_no, slope, middle_angle_degree`` of the line through the middles of the rows of edge points."""
    return with_middle_angle(of_points(points, lambda i, j: (contour.middle_slope(i, j),), "slope double"))


def with_middle_angle(rows: DataFrame) -> DataFrame:
    """Adds ``middle_angle_degree`` of the line's ``slope``."""
    return rows.withColumn("middle_angle_degree", middle_angle(-F.col("slope"), F.lit(-1.0)))


def extent(points: DataFrame, centers: DataFrame) -> DataFrame:
    """``run_id, frame_no, drop_height, drop_length``: least j against j at the point nearest to the horizontal centre;
    width of the row at the vertical centre, null if that row is empty."""
    both = points.join(centers.select(*FRAME, "h_center", "v_center"), FRAME)
    far = F.struct(F.abs(F.col("i") - F.floor("h_center")), "i", "j")
    at_row = F.when(F.col("j") == F.floor("v_center"), F.col("i"))
    out = both.groupBy(*FRAME).agg(F.min("j").alias("low"), F.min_by("j", far).alias("top"), (F.max(at_row) - F.min(at_row)).alias("drop_length"))
    return out.select(*FRAME, F.abs(F.col("low") - F.col("top")).alias("drop_height"), "drop_length")


def lookup_bounds(frames: DataFrame, detections: DataFrame, key: list[str]) -> DataFrame:
    """Frames with the bounds of their first detection; null where there is none, which is an error row and no failure."""
    once = detections.groupBy(*key).agg(F.min(F.struct("endpoint", "beginning")).alias("_d"))
    return frames.join(once, key, "left").select(*frames.columns, "_d.endpoint", "_d.beginning", F.col("_d").isNull().alias("missing"))


#: Up to which angle a fit takes how many points, of what degree.
WINDOWS = ((60.0, 60, 2), (105.0, 85, 2), (135.0, 125, 3), (None, 145, 4))


@dataclass(frozen=True)
class TwoPass:
    """Points and degree of the first fit on the left and on the right, and those of the second by the first angle
    (up to an angle, points, degree); the last window has no limit."""

    left: tuple[int, int] = (64, 3)
    right: tuple[int, int] = (65, 2)
    windows: tuple[tuple[float | None, int, int], ...] = WINDOWS


def contact(i: np.ndarray, j: np.ndarray, left: bool, degree: int) -> tuple[float, float] | None:
    """Angle and place at one contact: a polynomial gives i as a function of j over the points near it, and its first
    two of as many samples as there are points give the angle; None for too few distinct j."""
    n = len(j)
    if n < 2 or len(set(j.tolist())) <= degree:
        return None
    low, high = float(j.min()), float(j.max())
    # Within -1 to 1 the normal equations of low degrees are well conditioned.
    half = (high - low) / 2 or 1.0
    x = (j - (low + high) / 2) / half
    powers = x[:, None] ** np.arange(degree + 1)
    coef = np.linalg.solve(powers.T @ powers, powers.T @ i)
    step = (high - low) / (n - 1)
    first, second = (sum(float(c) * at**k for k, c in enumerate(coef)) for at in (-1.0, -1.0 + step / half))
    turn = degrees(atan((second - first) / step))
    return (90 - turn if left else 90 + turn), first


def measure(i: np.ndarray, j: np.ndarray, cfg: TwoPass = TwoPass()) -> list[float]:
    """adv, rec, left_point, right_point: the first pass chooses the second one's points and degree by its angle; NaN where a fit fails."""
    out = []
    for left, (points, degree) in ((True, cfg.left), (False, cfg.right)):
        final = None
        if len(i):
            # Both passes take their points from one order, nearest first.
            by = np.lexsort((j, i, (i - (i.min() if left else i.max())) ** 2 + j**2))
            rough = contact(i[by[:points]], j[by[:points]], left, degree)
            if rough is not None:
                # Whole angles stand at limits; what rounding adds to them doesn't count.
                angle = round(rough[0], 9)
                points, degree = next((p, d) for limit, p, d in cfg.windows if limit is None or angle <= limit)
                final = contact(i[by[:points]], j[by[:points]], left, degree)
        out.append(final or (np.nan, np.nan))
    return [out[0][0], out[1][0], out[0][1], out[1][1]]


#: What ``measure`` gives.
MEASURED = ("adv", "rec", "left_point", "right_point")


def _measured(i: np.ndarray, j: np.ndarray, cfg: TwoPass) -> list[float | None]:
    return [None if np.isnan(v) else v for v in measure(i.astype(float), j.astype(float), cfg)]


def two_pass(points: DataFrame, cfg: TwoPass = TwoPass()) -> DataFrame:
    """``run_id, frame_no, adv, rec, left_point, right_point``: angles and contact points of two passes of fits; null where a fit fails."""
    return of_points(points, lambda i, j: _measured(i, j, cfg), ", ".join(f"{n} double" for n in MEASURED))


def frame_measures(frames: DataFrame, low: int, high: int, margin: int, cfg: TwoPass = TwoPass(), keep: list[str] | None = None) -> DataFrame:
    """From pixels to adv, rec, both contact points, both centres and the slope of the middle line, in one kernel.

    Columns of ``keep`` stay (by default run and frame).  Nothing but these
    numbers leaves the kernel; a frame without an outline has nulls alone.
    """

    measured = outline_measures(low, high, margin, cfg)
    return with_middle_angle(with_kernel(frames, measured, ", ".join(f"{n} double" for n in OUTLINE), keep=keep or FRAME))


#: What ``outline_measures`` gives.
OUTLINE = (*MEASURED, "h_center", "v_center", "slope")


def outline_measures(low: int, high: int, margin: int, cfg: TwoPass) -> Callable[[np.ndarray], tuple | None]:
    """What measures a frame; None without an outline."""

    def kernel(a: np.ndarray) -> tuple | None:
        i, j = kernels.outline(a, low, high)
        if not len(i):
            return None
        return (*_measured(i, j, cfg), contour.horizontal_center(i, j, margin), contour.vertical_center(i, j, margin), contour.middle_slope(i, j))

    return kernel


def frame_angles(frames: DataFrame, low: int, high: int, cfg: TwoPass = TwoPass()) -> DataFrame:
    """``two_pass`` from pixels, without a table of points."""
    return with_kernel(frames, lambda a: _measured(*kernels.outline(a, low, high), cfg), ", ".join(f"{n} double" for n in MEASURED), keep=FRAME)
