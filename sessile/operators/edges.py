"""Edge points of a drop and the points near its contact lines."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessile.functions import kernels
from sessile.operators.arrow import of_points, rows_of


def edge_points(frames: DataFrame, low: int = 40, high: int = 255) -> DataFrame:
    """``run_id, frame_no, i, j``: per row the left and rightmost pixel in (low, high], per column the topmost; j counts upward.

    The search runs within a frame; only edge points become rows.
    """
    return rows_of(frames, lambda a: kernels.outline(a, low, high), "i int, j int")


def nearest(points: DataFrame, n: int, side: str) -> DataFrame:
    """The ``n`` points nearest to (least i, 0) for side "advancing", to (greatest i, 0) for "receding"; ties by (i, j).

    ``d2`` is the squared distance, ``rank`` counts from 1.
    """
    frame = Window.partitionBy("run_id", "frame_no")
    origin = (F.min("i") if side == "advancing" else F.max("i")).over(frame)
    d2 = (F.col("i") - origin) * (F.col("i") - origin) + F.col("j") * F.col("j")
    return points.withColumn("d2", d2.cast("long")).withColumn("rank", F.row_number().over(frame.orderBy("d2", "i", "j"))).filter(F.col("rank") <= n)


def by_distance(points: DataFrame, ox: int = 0, oy: int = 0) -> DataFrame:
    """Points with their ``ord`` from 0 by distance to (ox, oy); ties by (i, j)."""
    d2 = (F.col("i") - ox) * (F.col("i") - ox) + (F.col("j") - oy) * (F.col("j") - oy)
    return points.withColumn("d2", d2.cast("long")).withColumn("ord", F.row_number().over(Window.partitionBy("run_id", "frame_no").orderBy("d2", "i", "j")) - 1)


def nearest_path(points: DataFrame) -> DataFrame:
    """Points in path order: from the lowest, each time to the nearest one left (ties: lower, then more to the left).

    Sequential within a frame, whose edge has some thousand points; parallel over frames.
    """

    def kernel(i: np.ndarray, j: np.ndarray) -> tuple:
        order = kernels.greedy_path(i, j)
        return ([{"i": int(a), "j": int(b)} for a, b in zip(i[order], j[order], strict=True)],)

    found = of_points(points, kernel, "path array<struct<i int, j int>>")
    return found.select("run_id", "frame_no", F.posexplode("path").alias("ord", "p")).select("run_id", "frame_no", "ord", "p.i", "p.j")


def ordered_edges(frames: DataFrame, margin: int = 9, low: int = 10, size: int = 5) -> DataFrame:
    """``run_id, frame_no, ord, x, y``: the edge of the drop between ``endpoint`` and ``beginning`` in path order, in places of the whole frame.

    The frame's last row is left out, the rest is cut ``margin`` pixels beyond
    the bounds, closed and inverted.  ``y`` counts upward from 1.  Frames
    without bounds have no points.
    """
    mask = kernels.ellipse(size)

    def kernel(a: np.ndarray, left: int | None, right: int | None) -> tuple[np.ndarray, ...]:
        none = np.empty(0)
        if left is None or right is None or left >= right or a.shape[0] < 2:
            return none, none, none
        start = max(0, left - margin)
        i, j = kernels.outline(255 - kernels.close(a[:-1, start : right + margin], mask), low)
        order = kernels.greedy_path(i, j)
        return np.arange(len(order)), i[order] + float(start), j[order] + 1.0

    return rows_of(frames, kernel, "ord int, x double, y double", "endpoint", "beginning")
