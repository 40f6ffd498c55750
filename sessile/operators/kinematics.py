"""From measurements of frames to the time series of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.config import Settings


def to_cm(measured: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Contact length, contact points and centre in cm from pixels of the upscaled crop, whose left bound is x1."""
    unit, span = cfg.cm_on_pixel_ratio / cfg.upscale, cfg.frame_width * cfg.upscale
    far = lambda c: ((span - F.col(c) - F.col("x1") * cfg.upscale) * unit).alias(f"{c}_cm")
    return measured.select(
        "*",
        ((F.col("right_point") - F.col("left_point")) * unit).alias("contact_line_length"),
        far("left_point"),
        far("right_point"),
        ((span - F.col("h_center")) * unit).alias("x_center"),
        (F.col("v_center") * unit).alias("y_center"),
    )


def kinematics(measured: DataFrame, order: list[str], fps: float, x: str = "x_center", index: Column | None = None) -> DataFrame:
    """Adds ``time_s`` and ``velocity`` (to the next frame); a run's last row goes.

    Time counts the frames that were measured, so a failed frame shortens the
    clock; ``gap``, if an ``index`` is given, marks rows whose next one isn't
    the next index.
    """
    by_run = Window.partitionBy("run_id").orderBy(*order)
    new = {"time_s": (F.row_number().over(by_run) - 1) / fps, "_next": F.lead(x).over(by_run), "_last": F.lead(F.lit(1)).over(by_run).isNull()}
    if index is not None:
        new["gap"] = F.lead(index).over(by_run) - index > 1
    out = measured.withColumns(new).filter("not _last")
    return out.withColumn("velocity", (F.col("_next") - F.col(x)) * fps).drop("_next", "_last")
