"""Finding the drop in a frame: profiles, steps, guards, boxes and their fusion."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessile.functions import kernels
from sessile.operators.arrow import KEY, on_arrays, pixels, with_kernel, with_neighbours


def column_profile(frames: DataFrame, sx: int = 1, sy: int = 1, mask: np.ndarray | None = None) -> DataFrame:
    """Frames without their pixels, with ``vv`` and ``vv_mor``: sums of the columns of the shrunken frame divided by their mean, as it is and closed with ``mask``."""

    def kernel(a: np.ndarray) -> tuple:
        return kernels.profiles(a, sx, sy, mask)

    return with_kernel(frames, kernel, "vv array<double>, vv_mor array<double>", keep=[c for c in frames.columns if c not in ("vv", "vv_mor", "px")])


def closed_profile(frames: DataFrame, sx: int = 1, sy: int = 1, mask: np.ndarray | None = None) -> DataFrame:
    """Adds ``vv`` of frames that are shrunk, then closed, then summed: the detector with one profile."""
    return column_profile(frames, sx, sy, mask).withColumn("vv", F.col("vv_mor")).drop("vv_mor")


def left_step(profile: Column, steep: float) -> Column:
    """Place before the first jump by more than ``steep`` (at 10 to n - 11) of an array, null if there is none."""
    return on_arrays(lambda rows: kernels.first_jump(rows, steep), profile)


def right_step(profile: Column, steep: float) -> Column:
    """Place of the last jump (at 11 to n - 10), null if there is none."""
    return on_arrays(lambda rows: kernels.last_jump(rows, steep), profile)


def steps(frames: DataFrame, left: str, right: str, steep: float, steep_wide: float, scale: int = 1) -> DataFrame:
    """Adds ``near`` and ``far`` (left steps of array ``left``, the latter steeper) and ``end`` (right step of ``right``), in pixels."""
    found = {"near": left_step(F.col(left), steep), "far": left_step(F.col(left), steep_wide), "end": right_step(F.col(right), steep)}
    return frames.withColumns({c: v * scale for c, v in found.items()})


def steps_of(a: np.ndarray, steep: float, steep_wide: float, sx: int, sy: int, mask: np.ndarray, close_first: bool) -> tuple[int | None, int | None, int | None]:
    """``near``, ``far`` and ``end`` of a frame, in pixels; None where there is no step.

    The frame is closed, if asked, shrunk and summed; the left steps come from
    the profile of the frame closed once more, the right one from the profile
    before that.
    """
    vv, mor = (v[None] for v in kernels.profiles(kernels.close(a, mask) if close_first else a, sx, sy, mask))
    found = kernels.first_jump(mor, steep), kernels.first_jump(mor, steep_wide), kernels.last_jump(vv, steep)
    return tuple(None if v[0] < 0 else int(v[0]) * sx for v in found)


def frame_steps(frames: DataFrame, steep: float = 0.0025, steep_wide: float = 0.005, sx: int = 1, sy: int = 2, size: int = 13, close_first: bool = True) -> DataFrame:
    """``run_id, frame_no, near, far, end`` of every frame (``steps_of``), from pixels to integers in one kernel."""
    mask = kernels.ellipse(size)
    return with_kernel(frames, lambda a: steps_of(a, steep, steep_wide, sx, sy, mask, close_first), "near int, far int, end int", keep=KEY)


def guarded(width: Column | int) -> Column:
    """``endpoint`` (left) and ``beginning`` (right) of ``near``, ``far`` and ``end``: the steeper left step where the drop seems wider than ``width``."""
    near, far, end = F.col("near"), F.col("far"), F.col("end")
    return F.struct(F.when(end - near > width, far).otherwise(near).alias("endpoint"), end.alias("beginning"))


class Guards:
    """What a stretch of frames makes of the width guard it starts with.

    Starting guards fall into intervals ``[low, next low)``; those of one
    interval leave the same guard, or are left as they are (None).  One frame
    has two intervals at most, and stretches compose.
    """

    def __init__(self) -> None:
        self.lows: list[float] = [-np.inf]
        self.leaves: list[int | None] = [None]

    def then(self, limit: float | None, wide: int | None, narrow: int | None) -> None:
        """A frame whose width ``limit`` exceeds the guard leaves ``wide``, else ``narrow``; None leaves the guard."""
        if limit is None:
            return
        lows: list[float] = []
        leaves: list[int | None] = []

        def add(low: float, value: int | None) -> None:
            if not leaves or leaves[-1] != value:
                lows.append(low)
                leaves.append(value)

        for k, (low, value) in enumerate(zip(self.lows, self.leaves, strict=True)):
            if value is None:
                high = self.lows[k + 1] if k + 1 < len(self.lows) else np.inf
                if low < limit:
                    add(low, wide)
                if limit < high:
                    add(max(low, limit), narrow)
            else:
                new = wide if limit > value else narrow
                add(low, value if new is None else new)
        self.lows, self.leaves = lows, leaves

    def after(self, guard: int) -> int:
        value = self.leaves[int(np.searchsorted(self.lows, guard, side="right")) - 1]
        return guard if value is None else value


def _frame(near: float, far: float, end: float, growth: float) -> tuple[float | None, int | None, int | None]:
    grown = lambda at: None if np.isnan(at) or np.isnan(end) else int(np.floor(growth * (end - at)))
    # Without a width the first step counts, whatever the guard.
    return (None if grown(near) is None else end - near), grown(far), grown(near)


def _sorted(pdf: pd.DataFrame) -> tuple[np.ndarray, pd.DataFrame]:
    pdf = pdf.sort_values("frame_no", kind="stable")
    return pdf[["near", "far", "end"]].astype(float).to_numpy(), pdf


def _composed(growth: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = Guards()
        for near, far, end in _sorted(pdf)[0]:
            out.then(*_frame(near, far, end, growth))
        return pd.DataFrame({"run_id": [key[0]], "chunk": [key[1]], "lows": [out.lows], "leaves": [[np.nan if v is None else float(v) for v in out.leaves]]})

    return run


def _starts(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, now, out = pdf.sort_values("chunk"), width, []
        for lows, leaves in zip(pdf["lows"], pdf["leaves"], strict=True):
            out.append(now)
            stretch = Guards()
            stretch.lows, stretch.leaves = list(lows), [None if np.isnan(v) else int(v) for v in leaves]
            now = stretch.after(now)
        return pd.DataFrame({"of_run": pdf["run_id"], "of_chunk": pdf["chunk"], "start": np.array(out, dtype=np.int32)})

    return run


def fold_widths(steps_: np.ndarray, start: int, growth: float) -> tuple[list[float], list[int], int]:
    """Left bounds and guards of frames (rows near, far, end; NaN for none) in order, and the guard after them."""
    now, endpoints, widths = start, [], []
    for near, far, end in steps_:
        endpoint = far if end - near > now else near
        endpoints.append(endpoint)
        widths.append(now)
        grown = growth * (end - endpoint)
        if grown == grown:
            now = int(np.floor(grown))
    return endpoints, widths, now


def _folded(growth: float, frame_type: str):
    def run(frames: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        values, frames = _sorted(frames)
        endpoints, widths, _ = fold_widths(values, int(start["start"].iloc[0]) if len(start) else 0, growth)
        whole = lambda v: pd.Series(v, dtype=float).round().astype("Int32")
        return pd.DataFrame({"run_id": frames["run_id"].to_numpy(), "frame_no": frames["frame_no"].to_numpy(), "endpoint": whole(endpoints), "beginning": whole(values[:, 2]), "width": np.array(widths, dtype=np.int32)})

    return run


def carried_bounds(found: DataFrame, width: int = 300, growth: float = 1.13, chunk: int = 4096) -> DataFrame:
    """``run_id, frame_no, endpoint, beginning, width`` of frames with ``near``, ``far`` and ``end``: the width guard goes from frame to frame.

    The guard of the next frame is ``growth`` times this one's width.  Frames
    without bounds pass the guard on.  A run is cut into stretches of ``chunk``
    frame numbers.  What a stretch makes of any starting guard is a short list
    of intervals; those of a run give each stretch its start, and all stretches
    then fold on their own.  No task holds more than ``chunk`` frames, or than
    one short row for each of a run's stretches.
    """
    types = dict(found.dtypes)
    run_type, frame_type = types["run_id"], types["frame_no"]
    found = found.select(*KEY, *[F.col(c).cast("double").alias(c) for c in ("near", "far", "end")], F.floor(F.col("frame_no") / chunk).cast("long").alias("chunk"))
    maps = found.groupBy("run_id", "chunk").applyInPandas(_composed(growth), f"run_id {run_type}, chunk long, lows array<double>, leaves array<double>")
    starts = maps.groupBy("run_id").applyInPandas(_starts(width), f"of_run {run_type}, of_chunk long, start int")
    folded = found.groupBy("run_id", "chunk").cogroup(starts.groupBy("of_run", "of_chunk"))
    return folded.applyInPandas(_folded(growth, frame_type), f"run_id {run_type}, frame_no {frame_type}, endpoint int, beginning int, width int")


def adaptive_bounds(frames: DataFrame, profile: str, steep: float, steep_wide: float, width: int, growth: float, right: str | None = None, scale: int = 1) -> DataFrame:
    """``carried_bounds`` of the steps of arrays: left ones of ``profile``, right ones of ``right`` (the same one if none is named)."""
    return carried_bounds(steps(frames, profile, right or profile, steep, steep_wide, scale), width, growth)


def is_clear(a: np.ndarray, rows: tuple[int, int] = (-25, -5), left: tuple[int, int] = (0, 40), right: tuple[int, int] = (-40, -1), least: float = 20.0) -> bool:
    """Whether neither border region is dark, that is, the drop touches no border. A region without pixels isn't dark."""
    means = [kernels.region_mean(a, rows, c) for c in (left, right)]
    return all(m is None or m >= least for m in means)


def edge_guard(frames: DataFrame, rows: tuple[int, int] = (-25, -5), left: tuple[int, int] = (0, 40), right: tuple[int, int] = (-40, -1), least: float = 20.0, keep: list[str] | None = None) -> DataFrame:
    """Adds ``clear`` (``is_clear``)."""
    return with_kernel(frames, lambda a: (is_clear(a, rows, left, right, least),), "clear boolean", keep=keep)


class Detector(Protocol):
    """What finds drops in a frame; made once for each task."""

    def detect(self, image: np.ndarray) -> list[tuple[float, float, float, float, float]]:
        """Boxes x1, y1, x2, y2 and their confidence."""


def boxes(frames: DataFrame, make: Callable[[], Detector]) -> DataFrame:
    """``run_id, frame_no, x1, y1, x2, y2, conf``: a row for each box that the detector of ``make`` finds."""
    names = ["x1", "y1", "x2", "y2", "conf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = make()
        for batch in batches:
            found = []
            for p, h, w in zip(*(batch[c].to_pylist() for c in ("px", "height", "width")), strict=True):
                a = pixels(p, h, w)
                found.append([] if a is None else list(detector.detect(a)))
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            values = np.array([b for f in found for b in f], dtype=float).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([*(batch[c].take(at) for c in KEY), *(pa.array(values[:, k]) for k in range(5))], names=[*KEY, *names])

    types = dict(frames.dtypes)
    shape = ", ".join([*(f"{c} {types[c]}" for c in KEY), *(f"{n} double" for n in names)])
    return frames.select(*KEY, "px", "height", "width").mapInArrow(run, shape)


def best_box(found: DataFrame, least: float = 0.8, key: tuple[str, ...] = ("run_id", "frame_no")) -> DataFrame:
    """Of each frame the box of most confidence (ties: leftmost), of those that have enough."""
    top = F.max_by(F.struct("x1", "x2", "conf"), F.struct(F.col("conf"), -F.col("x1"), -F.col("x2")))
    return found.filter(F.col("conf") >= least).groupBy(*key).agg(top.alias("box")).select(*key, "box.x1", "box.x2", "box.conf")


def fused(model: DataFrame, sums: DataFrame, clear: DataFrame, key: tuple[str, ...] = ("run_id", "frame_no")) -> DataFrame:
    """``key, x1, x2, found`` of every frame of ``clear``: left by the model, right the further of both; one alone counts."""
    a = model.select(*key, F.col("x1").alias("m1"), F.col("x2").alias("m2"))
    b = sums.select(*key, F.col("x1").alias("s1"), F.col("x2").alias("s2"))
    both = clear.join(a, list(key), "left").join(b, list(key), "left")
    found = F.coalesce("m1", "s1").isNotNull() & F.col("clear")
    return both.select(*key, F.coalesce("m1", "s1").alias("x1"), F.greatest("m2", "s2").alias("x2"), found.alias("found"))


def found_drops(frames: DataFrame, make: Callable[[], Detector] | None = None, conf: float = 0.8, width: int = 300, sx: int = 5, steep: float = 0.0025, steep_wide: float = 0.005) -> DataFrame:
    """``run_id, frame_no, x1, x2, found`` of every frame: profile bounds, the boxes of a model if there is one, and the edge guard."""
    own = frame_steps(frames, steep, steep_wide, sx, close_first=False).select(*KEY, guarded(width).alias("b"))
    sums = own.select(*KEY, F.col("b.endpoint").alias("x1"), F.col("b.beginning").alias("x2")).filter("x1 is not null and x2 is not null")
    clear = edge_guard(frames, keep=KEY)
    if make is None:
        model = sums.select(*KEY, F.lit(None).cast("int").alias("x1"), F.lit(None).cast("int").alias("x2")).filter(F.lit(False))
    else:
        model = best_box(boxes(frames, make), conf).select(*KEY, F.col("x1").cast("int").alias("x1"), F.col("x2").cast("int").alias("x2"))
    return fused(model, sums, clear)


def _apart(row: tuple, before: tuple | None) -> np.ndarray | None:
    """How far each pixel is from the previous frame's; None without one of the same size."""
    a, b = pixels(*row), None if before is None else pixels(*before)
    return None if a is None or b is None or a.shape != b.shape else np.maximum(a, b) - np.minimum(a, b)


def difference_box(frames: DataFrame, threshold: int = 30) -> DataFrame:
    """``run_id, frame_no, changed, x1, x2, y1, y2``: bounding box of what differs from the run's previous frame, which the
    first one lacks; null where there is no picture to compare or nothing differs."""

    def kernel(row: tuple, before: tuple | None, _: None) -> tuple | None:
        if before is None:
            return None
        apart = _apart(row, before)
        if apart is None:
            return (None,) * 5
        apart = apart > threshold
        xs, ys = np.flatnonzero(apart.any(axis=0)), np.flatnonzero(apart.any(axis=1))
        return (int(apart.sum()), *([int(xs[0]), int(xs[-1]), int(ys[0]), int(ys[-1])] if len(xs) else [None] * 4))

    return with_neighbours(frames, kernel, "changed int, x1 int, x2 int, y1 int, y2 int", keep=KEY)


def largest_change(frames: DataFrame, threshold: int = 30, least: int = 500, size: int = 5) -> DataFrame:
    """``run_id, frame_no, x1, x2`` of the largest part that differs from the run's previous frame, opened and dilated twice; null without one."""
    mask = np.ones((size, size), dtype=bool)

    def kernel(row: tuple, before: tuple | None, _: None) -> tuple | None:
        if before is None:
            return None
        apart = _apart(row, before)
        if apart is None:
            return None, None
        moved = kernels.opened(kernels.threshold(apart, threshold), mask)
        part = kernels.largest_component(kernels.dilate(kernels.dilate(moved, mask), mask) > 0, least)
        at = np.flatnonzero(part.any(axis=0))
        return (int(at[0]), int(at[-1])) if len(at) else (None, None)

    return with_neighbours(frames, kernel, "x1 int, x2 int", keep=KEY)
