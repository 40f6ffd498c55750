"""From files of frames to the table that the analysis starts with, and what is wrong with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessile.operators import images, scan
from sessile.sources import files
from sessile.storage import materialize


def ingested(spark: SparkSession, root: str, pattern: str = "frame*.png", height: int = 130, other: str = "*.jpg") -> tuple[DataFrame, DataFrame]:
    """Gray frames of at least ``height`` rows, below ``root/<run>/<folder>``, and the problems found: run_id, frame_no, problem.

    Runs without any file of the pattern give those of the ``other`` one.
    Problems are files that are no image, gaps in the numbers, and runs whose
    lowest row shows the surface (those have none of their frames in the table).
    Files are listed and read once; all else comes from the table written then.
    """
    every = materialize(images.padded_top(files.files_as_frames(spark, root, pattern, other), height), "frames")
    found = files.preferred(every, every.filter("first").select("run_id"))
    frames = found.filter("px is not null")
    rejected = materialize(scan.surface_check(frames).filter("rejected").select("run_id"), "rejected")
    broken = found.filter("px is null").select("run_id", "frame_no", F.lit("no image").alias("problem"))
    gaps = scan.index_gaps(frames, "frame_no").select("run_id", "frame_no", F.concat(F.lit("missing before: "), F.col("missing")).alias("problem"))
    bright = rejected.select("run_id", F.lit(None).cast("int").alias("frame_no"), F.lit("surface in the lowest row").alias("problem"))
    return frames.join(rejected, "run_id", "left_anti"), broken.unionByName(gaps).unionByName(bright)
