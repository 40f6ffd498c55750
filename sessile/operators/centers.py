"""Horizontal and vertical centres of a drop, from its frame or from a table of its edge points."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from sessile.functions import contour, kernels
from sessile.operators.arrow import KEY, of_points, with_kernel


def horizontal_center(points: DataFrame, margin: int = 4) -> DataFrame:
    """``run_id, frame_no, h_center`` by ``contour.horizontal_center``."""
    return of_points(points, lambda i, j: (contour.horizontal_center(i, j, margin),), "h_center double")


def vertical_center(points: DataFrame, margin: int = 4) -> DataFrame:
    """``run_id, frame_no, v_center`` by ``contour.vertical_center``."""
    return of_points(points, lambda i, j: (contour.vertical_center(i, j, margin),), "v_center double")


def frame_centers(frames: DataFrame, low: int = 40, high: int = 255, margin: int = 4) -> DataFrame:
    """``run_id, frame_no, h_center, v_center`` of frames, without a table of points; null where a frame has no outline."""

    def kernel(a: np.ndarray) -> tuple:
        i, j = kernels.outline(a, low, high)
        return contour.horizontal_center(i, j, margin), contour.vertical_center(i, j, margin)

    return with_kernel(frames, kernel, "h_center double, v_center double", keep=KEY)
