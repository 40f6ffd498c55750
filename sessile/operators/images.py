"""Whole-frame stages: morphology, masks, enlarging, levelling, crops, decoding."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessile.functions import kernels
from sessile.operators.arrow import KEY, with_kernel

PIXELS = "px binary, height int, width int"


def packed(a: np.ndarray) -> tuple[bytes, int, int]:
    """A frame as the columns ``px``, ``height``, ``width``."""
    return np.ascontiguousarray(a, dtype=np.uint8).tobytes(), a.shape[0], a.shape[1]


def map_pixels(frames: DataFrame, kernel: Callable[..., np.ndarray], *arguments: str) -> DataFrame:
    """Frames with ``kernel`` applied to their pixels; a kernel of another shape changes width and height, too.

    A row whose pixels don't fill its frame gets null pixels and sizes.
    """
    return with_kernel(frames, lambda a, *more: packed(kernel(a, *more)), PIXELS, *arguments)


def closed(frames: DataFrame, size: int, shape: str = "ellipse") -> DataFrame:
    mask = kernels.ellipse(size) if shape == "ellipse" else np.ones((size, size), dtype=bool)
    return map_pixels(frames, lambda a: kernels.close(a, mask))


def padded_top(frames: DataFrame, least: int = 130) -> DataFrame:
    """Frames of at least ``least`` rows: white ones come on top."""
    return map_pixels(frames, lambda a: kernels.pad_top(a, least))


def reflection_mask(frames: DataFrame, dark: int = 10, level: int = 100) -> DataFrame:
    """White where the largest dark part of the opened frame isn't, black in it."""
    mask = np.ones((5, 5), dtype=bool)

    def kernel(a: np.ndarray) -> np.ndarray:
        part = kernels.largest_component(kernels.threshold(kernels.opened(a, mask), dark, 250, inverse=True) > level)
        return np.where(part, 0, 255)

    return map_pixels(frames, kernel)


def boundary_mask(frames: DataFrame, level: int = 100) -> DataFrame:
    """Frames with their largest dark part blanked out."""

    def kernel(a: np.ndarray) -> np.ndarray:
        part = kernels.largest_component(kernels.threshold(kernels.blur(255 - a), 255 - level) > 0)
        return np.where(part, 0, a)

    return map_pixels(frames, kernel)


#: What enlarges a frame of pixels in 0..1; made once for each task.
Model = Callable[[np.ndarray], np.ndarray]


class _Once:
    """The result of ``make``, made where it is first used and never sent along."""

    def __init__(self, make: Callable[[], Model]) -> None:
        self.make, self.made = make, None

    def __getstate__(self) -> dict:
        return {"make": self.make, "made": None}

    def __call__(self, image: np.ndarray) -> np.ndarray:
        if self.made is None:
            self.made = self.make()
        return self.made(image)


def enlarged(image: np.ndarray, model: Model, smooth: bool = True) -> np.ndarray:
    """A gray frame stretched to 0..1, enlarged by ``model``, brought back to 0..255, smoothed and closed."""
    out = np.clip(model(kernels.min_max(image)) * 255.0, 0, 255).astype(np.uint8)
    return kernels.close(kernels.blur(out), kernels.ellipse(5)) if smooth else out


def enlarged_colour(rgb: np.ndarray, model: Model) -> np.ndarray:
    """The gray frame of a coloured one: luma by ``model``, chroma by cubic interpolation, together, then as ``enlarged``."""
    y, cr, cb = kernels.luma_chroma(rgb)
    bright = enlarged(y, model, smooth=False)
    both = kernels.from_luma_chroma(bright, *(kernels.cubic(c, *bright.shape) for c in (cr, cb)))
    gray = np.floor(both.astype(float) @ kernels.LUMA + 0.5).astype(np.uint8)
    return kernels.close(kernels.blur(gray), kernels.ellipse(5))


def linear(times: int = 3) -> Model:
    """Linear interpolation, which stands in for a network whose weights aren't public."""
    return lambda image: kernels.resized(np.floor(image * 255 + 0.5).astype(np.uint8), image.shape[0] * times, image.shape[1] * times) / 255.0


def enlarger(times: int = 3, make: Callable[[], Model] | None = None) -> Callable[[np.ndarray], np.ndarray]:
    """What enlarges frames by the model of ``make``, which is made once in each task, or by linear interpolation."""
    model = _Once(make or (lambda: linear(times)))
    return lambda a: enlarged(a, model)


def upscaled(frames: DataFrame, times: int = 3, make: Callable[[], Model] | None = None, name: str = "network") -> DataFrame:
    """Frames enlarged ``times``, smoothed and closed; ``sr_model`` names the model of ``make``, or "linear" without one."""
    return map_pixels(frames, enlarger(times, make)).withColumn("sr_model", F.lit("linear" if make is None else name))


def seed(*key: str) -> F.Column:
    return F.concat_ws("/", *(key or KEY))


def seed_number(key: str) -> int:
    return zlib.crc32(key.encode())


def surface_of(a: np.ndarray, seed: int, share: float, residual: float, trials: int) -> tuple[float, float] | None:
    """Angle (degrees) and middle row of the line through the edges of the lowest ``share`` of rows."""
    top = int(a.shape[0] * (1 - share))
    y, x = np.nonzero(kernels.edges(kernels.blur(a[top:], 5)))
    line = kernels.ransac_line(y.astype(float), x.astype(float), seed, residual, trials)
    return None if line is None else (float(np.degrees(np.arctan(line[0]))), float(top + line[1] + line[0] * (x.min() + x.max()) / 2))


def surface_line(frames: DataFrame, share: float = 0.3, residual: float = 1.0, trials: int = 5000, drop: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``angle`` (degrees) and ``line_y`` of the surface, from a line through the edges of the lowest ``share`` of rows.

    The random search is seeded by run and frame, so it repeats. Null where
    there are no edges. Columns of ``drop`` don't come along.
    """

    return with_kernel(frames, lambda a, seed: surface_of(a, seed_number(seed), share, residual, trials), "angle double, line_y double", seed(), keep=[c for c in frames.columns if c not in ("angle", "line_y", *drop)])


def line_heights(frames: DataFrame, above: int = 10, residual: float = 2.0, trials: int = 1000) -> DataFrame:
    """``run_id, frame_no, line_height`` of the surface in frames turned by ``angle`` about their middle, ``above`` rows over the line."""

    def kernel(a: np.ndarray, angle: float, seed: str) -> tuple:
        turn = 0.0 if angle is None or angle != angle else angle
        return (kernels.surface_height(a, turn, (a.shape[1] // 2, a.shape[0] // 2), seed_number(seed), above, residual, trials),)

    return with_kernel(frames, kernel, "line_height int", "angle", seed(), keep=KEY)


def levelled(frames: DataFrame) -> DataFrame:
    """Frames turned by their column ``angle`` about their middle, so that the surface lies flat."""
    return map_pixels(frames, lambda a, angle: kernels.rotated(a, 0.0 if angle is None or angle != angle else angle, (a.shape[1] / 2, a.shape[0] / 2)), "angle")


def run_baseline(heights: DataFrame, margin: int = 10) -> DataFrame:
    """Adds ``baseline`` of the run (mean height, truncated) and ``cut`` (first row that is surface) to rows with ``line_height``."""
    base = heights.groupBy("run_id").agg(F.avg("line_height").cast("int").alias("baseline"))
    return heights.join(base, "run_id").withColumn("cut", F.col("baseline") + margin)


def stood(a: np.ndarray, angle: float | None, baseline: float | None, margin: int = 10, every: int = 50, least: int = 2) -> np.ndarray:
    """A frame turned by ``angle`` about (middle, ``baseline`` + margin), black from there on, the drop standing on five
    black rows; without either it stays as it is but for the black rows."""
    if angle == angle and angle is not None and baseline == baseline and baseline is not None:
        cut = max(0, int(baseline) + margin)
        a = kernels.rotated(a, angle, (a.shape[1] // 2, cut))
        a[cut:] = 0
    return kernels.unified(a, a.shape[0], kernels.bottom_row(a, every, least))


def standing(frames: DataFrame, margin: int = 10, every: int = 50, least: int = 2) -> DataFrame:
    """Frames through ``stood`` with their columns ``angle`` and ``baseline``."""
    return map_pixels(frames, lambda a, angle, baseline: stood(a, angle, baseline, margin, every, least), "angle", "baseline")


def bottom_row(frames: DataFrame, every: int = 50, least: int = 2) -> DataFrame:
    """``run_id, frame_no, bottom``: above the lowest row whose sampled columns sum to more than ``least`` (down to row 1, else 0)."""
    return with_kernel(frames, lambda a: (kernels.bottom_row(a, every, least),), "bottom int", keep=KEY)


def unified(frames: DataFrame, target: int, pad_bottom: int = 5) -> DataFrame:
    """Frames cut above ``bottom``, padded white on top to ``target - 1`` rows and black below."""
    return map_pixels(frames, lambda a, bottom: kernels.unified(a, target, int(bottom), pad_bottom), "bottom")


def cut_out(a: np.ndarray, left: float | None, right: float | None, margin: int, bottom_rows: int) -> tuple[np.ndarray, int] | None:
    """The inverted frame from ``margin`` pixels before ``left`` to as many beyond ``right``, without its lowest rows, and
    where it starts; None where the bounds aren't in order."""
    if left is None or right is None or not left < right:
        return None
    start = max(0, int(left) - margin)
    cut = 255 - a[: a.shape[0] - bottom_rows, start : max(0, int(right) + margin)]
    return (cut, start) if cut.size else None


def cropped(frames: DataFrame, margin: int = 15, bottom_rows: int = 0) -> DataFrame:
    """Frames cut to ``margin`` pixels beyond ``endpoint`` and ``beginning``, clamped to the frame, inverted; adds their left end ``x1``.

    The lowest ``bottom_rows`` are left out.  Pixels are null where the bounds
    aren't in order.
    """

    def kernel(a: np.ndarray, left: float, right: float) -> tuple | None:
        found = cut_out(a, left, right, margin, bottom_rows)
        return None if found is None else (*packed(found[0]), found[1])

    return with_kernel(frames, kernel, f"{PIXELS}, x1 int", "endpoint", "beginning")


def totals(frames: DataFrame) -> DataFrame:
    """Frames without their pixels, with how many there are, ``pixels``, and their ``total``."""
    return with_kernel(frames, lambda a: (int(a.size), float(a.sum(dtype=np.int64))), "pixels int, total double", keep=[c for c in frames.columns if c != "px"])


def decoded(images: DataFrame, keep_broken: bool = False) -> DataFrame:
    """Gray frames from rows of Spark's image source: origin, height, width, px. Three channels become luma; bad files are
    left out, or have nulls if they are to be kept."""

    def one(data: bytes | None, n: int) -> bytes | None:
        if data is None or n == 1:
            return data
        bgr = np.frombuffer(data, dtype=np.uint8).reshape(-1, n)[:, :3].astype(float)
        return np.floor(bgr @ kernels.LUMA[::-1] + 0.5).astype(np.uint8).tobytes()

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for data, n in batches:
            yield pd.Series([one(d, int(c)) for d, c in zip(data, n, strict=True)], dtype=object)

    good = F.col("image.height") > 0
    rows = images if keep_broken else images.filter(good)
    sizes = [F.when(good, F.col(f"image.{c}")).alias(c) for c in ("height", "width")]
    return rows.select("image.origin", *sizes, F.pandas_udf(run, "binary")(F.when(good, F.col("image.data")), F.col("image.nChannels")).alias("px"))
