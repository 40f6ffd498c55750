"""The analysis of frames: levelling, pruning, trimming, detection, crop, measurement, time series.

Pixels are read three times: for what the surface of each run is like; to level
the frames, which are written with all that detection needs of them as numbers;
and to measure the frames that stay.  Between these, only numbers and ranges of
frames (``operators.ranges``) are shuffled; frames stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessile.config import Settings
from sessile.functions import kernels
from sessile.operators import detect, fit, images, kinematics, prune, ranges
from sessile.operators.arrow import KEY, with_kernel
from sessile.storage import discard, materialize

_SURFACE = "mean double, angle double, x0 double, y0 double, x1 double, y1 double"
_LOOKED = f"{images.PIXELS}, s_near int, s_far int, s_end int, clear boolean, near int, far int, end int"


def surfaces(frames: DataFrame, cfg: Settings = Settings(), level: bool = True, every: int = 4) -> DataFrame:
    """``run_id, rejected, angle, baseline`` of every run, from one look at each frame.

    A run is rejected if the lowest row of one in ``every`` frames is bright.
    The angle is that of its third frame's surface (of the last one's in a
    shorter run), 0 without one; the baseline the mean height, over all frames,
    of the line through their edges after turning.  Without ``level`` there is
    neither.
    """

    def kernel(a: np.ndarray, key: str, place: int, size: int) -> tuple:
        mean = float(a[-1].mean()) if place % every == 0 else None
        if not level:
            return mean, *[None] * 5
        seed = images.seed_number(key)
        tilt = images.surface_of(a, seed, cfg.surface_share, 1.0, cfg.angle_trials) if place == min(cfg.angle_frame, size) - 1 else None
        y, x = np.nonzero(kernels.edges(a))
        return mean, tilt and tilt[0], *(kernels.line_ends(x, y, seed, 2.0, cfg.height_trials) or [None] * 4)

    known = materialize(ranges.stretches(frames.select(*KEY)), "runs")
    rows = ranges.with_places(frames.select(*KEY, "px", "height", "width"), known)
    rows = materialize(with_kernel(rows, kernel, _SURFACE, images.seed(), "_n", "_all", keep=["run_id", "height", "width"]), "surfaces")
    runs = rows.groupBy("run_id").agg(F.coalesce(F.max(F.col("mean") > cfg.surface_bright), F.lit(False)).alias("rejected"), F.coalesce(F.max("angle"), F.lit(0.0)).alias("angle"))

    def turned(x: str, y: str) -> Column:
        """Height of a point of the frame after turning it about its middle."""
        t, cx, cy = F.radians("angle"), F.floor(F.col("width") / 2), F.floor(F.col("height") / 2)
        return cy - F.sin(t) * (F.col(x) - cx) + F.cos(t) * (F.col(y) - cy)

    height = F.floor((turned("x0", "y0") + turned("x1", "y1")) / 2) - cfg.surface_margin
    out = rows.drop("angle").join(runs, "run_id").groupBy("run_id", "rejected", "angle").agg(F.avg(height).cast("int").alias("baseline"))
    out = materialize(out, "runs")
    discard(rows, known)
    return out


def of_runs(frames: DataFrame, runs: DataFrame) -> DataFrame:
    """``frames`` with their run's ``angle`` and ``baseline``; those of rejected runs go.  ``runs`` is a written table."""
    good = runs.filter("not rejected").select("run_id", "angle", "baseline")
    return frames.join(F.broadcast(good) if good.count() <= ranges.MOST else good.hint("merge"), "run_id")


def levelled_runs(frames: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Frames with the surface flat and the drop standing on black rows, whatever their lowest row is like."""
    runs = surfaces(frames, cfg).withColumn("rejected", F.lit(False))
    return images.standing(of_runs(frames, runs), cfg.surface_margin).drop("angle", "baseline")


def looked_at(frames: DataFrame, cfg: Settings = Settings(), level: bool = True) -> DataFrame:
    """Frames with ``angle`` and ``baseline``, levelled if asked, with the steps of the detector (``s_near``, ``s_far``,
    ``s_end``), ``clear`` and the steps of the final bounds."""
    mask = kernels.ellipse(13)

    def kernel(a: np.ndarray, angle: float | None, baseline: float | None) -> tuple:
        a = images.stood(a, angle, baseline, cfg.surface_margin) if level else a
        rough = detect.steps_of(a, cfg.steep, cfg.steep_wide, cfg.detector_scale, 2, mask, False)
        fine = detect.steps_of(a, cfg.steep, cfg.steep_wide, cfg.profile_scale, 2, mask, True)
        return *images.packed(a), *rough, detect.is_clear(a), *fine

    return with_kernel(frames, kernel, _LOOKED, "angle", "baseline", keep=KEY)


def drop_ranges(frames: DataFrame, make: Callable[[], detect.Detector] | None = None, cfg: Settings = Settings()) -> DataFrame:
    """The ranges of ``looked_at`` frames that show a drop: chunks without one go, coarse to fine, and what lies before it
    comes in and after it leaves.  A detector of ``make`` sees the ends of chunks, and what they leave, alone."""
    near, far, end = F.col("s_near"), F.col("s_far"), F.col("s_end")
    x1 = F.when(end - near > cfg.drop_width, far).otherwise(near)
    seen = frames.select(*KEY, x1.alias("x1"), end.alias("x2"), F.coalesce(x1.isNotNull() & end.isNotNull() & F.col("clear"), F.lit(False)).alias("found"))

    def found(part: DataFrame) -> DataFrame:
        return detect.found_drops(part.select(*KEY, "px", "height", "width"), make, cfg.yolo_conf, cfg.drop_width, cfg.detector_scale, cfg.steep, cfg.steep_wide)

    kept = materialize(ranges.stretches(frames.select(*KEY)), "kept")
    for skip in cfg.skips:
        kept = materialize(ranges.pruned(kept, skip, seen), "kept") if make is None else prune.detected_ranges(frames, kept, skip, found)
    seen = ranges.within(seen, kept) if make is None else found(ranges.within(frames, kept))
    return materialize(ranges.clipped(kept, prune.entered(seen, ["frame_no"], cfg.trim_right, cfg.trim_left)), "used")


def bounded(frames: DataFrame, used: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """``looked_at`` frames in the ranges ``used`` with the drop's bounds ``endpoint`` and ``beginning``.

    The width guard is carried along a run over the numbers alone.  It tells
    which frames take the steeper left step; these are ranges, too.
    """
    steps = materialize(ranges.within(frames.select(*KEY, "near", "far", "end"), used), "steps")
    carried = detect.carried_bounds(steps, cfg.drop_width, cfg.width_growth).select(*KEY, "width")
    wide = carried.join(steps, KEY).filter(F.col("end") - F.col("near") > F.col("width"))
    wide = materialize(ranges.stretches(wide.select(*KEY)).withColumn("wide", F.lit(True)), "wide")
    out = ranges.within(ranges.within(frames, used), wide, "wide", how="left")
    return out.withColumns({"endpoint": F.when(F.col("wide"), F.col("far")).otherwise(F.col("near")), "beginning": F.col("end")})


def crops(frames: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Inverted cuts around the bounds of ``frames``, enlarged; frames without bounds have null pixels."""
    return images.upscaled(images.cropped(frames, cfg.crop_margin, cfg.bottom_rows), cfg.upscale)


def _described(rows: DataFrame, cfg: Settings) -> DataFrame:
    """Measures with lengths in cm, and for those that failed an ``error_class`` and a ``message``."""
    error = F.when(F.col("h_center").isNull(), "NoEdge").when(F.col("adv").isNull() | F.col("rec").isNull(), "NoContactLine")
    said = F.when(F.col("h_center").isNull(), "no pixel above the threshold").otherwise("too few distinct edge points near a contact")
    # The centre counts from the frame's left end, not the crop's.
    rows = rows.drop("slope").withColumn("h_center", F.col("h_center") + cfg.upscale * F.col("x1"))
    return kinematics.to_cm(rows, cfg).withColumn("error_class", error).withColumn("message", F.when(F.col("error_class").isNotNull(), said))


def measured(frames: DataFrame, low: int, high: int, margin: int, cfg: Settings = Settings(), fits: fit.TwoPass = fit.TwoPass()) -> DataFrame:
    """Angles, contact length and centre of every frame; a frame that can't be measured has an ``error_class`` and a ``message``.

    ``frames`` are crops: run_id, frame_no, width, height, px and the left bound x1.
    """
    return _described(fit.frame_measures(frames, low, high, margin, fits, [*KEY, "x1"]), cfg)


def crops_measured(frames: DataFrame, margin: int, cfg: Settings = Settings(), fits: fit.TwoPass = fit.TwoPass(), make: Callable[[], images.Model] | None = None) -> DataFrame:
    """``measured`` of the ``crops`` of frames with bounds, without a table of crops: cut, enlarge and measure in one kernel."""
    enlarge, measure = images.enlarger(cfg.upscale, make), fit.outline_measures(cfg.mask_low, cfg.mask_high, margin, fits)

    def kernel(a: np.ndarray, left: int | None, right: int | None) -> tuple | None:
        found = images.cut_out(a, left, right, cfg.crop_margin, cfg.bottom_rows)
        return None if found is None else (found[1], *(measure(enlarge(found[0])) or [None] * len(fit.OUTLINE)))

    rows = with_kernel(frames, kernel, ", ".join(["x1 int", *(f"{n} double" for n in fit.OUTLINE)]), "endpoint", "beginning", keep=KEY)
    return _described(fit.with_middle_angle(rows), cfg)


def analysed(raw: DataFrame, cfg: Settings = Settings(), margin: int = 4, make: Callable[[], detect.Detector] | None = None, level: bool = True, fits: fit.TwoPass = fit.TwoPass()) -> tuple[DataFrame, DataFrame]:
    """From gray frames (run_id, frame_no, width, height, px) to the time series of every run, and the measurements behind it.

    Runs whose surface is out of sight go; frames are levelled, pruned and
    trimmed; bounds, crop, enlarging and two passes of fits give measurements,
    of which those with an ``error_class`` are left out of the series.  A
    ``gap`` marks a row whose next frame isn't the next number.
    """
    frames = materialize(looked_at(of_runs(raw, surfaces(raw, cfg, level)), cfg, level), "looked-at")
    used = drop_ranges(frames, make, cfg)
    rows = materialize(crops_measured(bounded(frames, used, cfg), margin, cfg, fits), "measured")
    discard(frames)
    series = kinematics.kinematics(rows.filter("error_class is null"), ["frame_no"], cfg.fps_experiment, index=F.col("frame_no"))
    return series, rows
