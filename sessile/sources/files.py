"""Frames, videos and detections as files of run folders."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessile.operators.images import decoded


def _run_of(path: Column, levels: int) -> Column:
    """Name of the folder ``levels`` above a file."""
    return F.element_at(F.split(path, "/"), -1 - levels)


def frame_number(path: Column) -> Column:
    """First run of digits of the file name; null without one."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.nullif(F.regexp_extract(name, r"([0-9]+)", 1), F.lit("")).cast("int")


def list_frames(spark: SparkSession, root: str, pattern: str = "frame*.png", other: str = "*.jpg") -> DataFrame:
    """``run_id, frame_no, path, length`` of ``root/<run>/<folder>/frame_*``; contents are not read.

    Runs without any such file list those of the ``other`` pattern.
    """

    def found(name: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
        return files.select(_run_of(F.col("path"), 2).alias("run_id"), frame_number(F.col("path")).alias("frame_no"), "path", "length")

    first = found(pattern)
    return first.unionByName(found(other).join(first.select("run_id").distinct(), "run_id", "left_anti"))


def list_videos(spark: SparkSession, root: str) -> DataFrame:
    """``path, run_id`` of every mp4 below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.mp4").load(root)
    return files.select("path", _run_of(F.col("path"), 1).alias("run_id"))


def _named(path: Column, pattern: str) -> Column:
    """Whether a file's name fits a pattern of ``*`` and ``?``."""
    plain = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern)
    return F.element_at(F.split(path, "/"), -1).rlike(f"^{plain}$")


def files_as_frames(spark: SparkSession, root: str, pattern: str = "frame*.png", other: str = "*.jpg") -> DataFrame:
    """``run_id, frame_no, first, height, width, px`` of every file of either pattern, from one listing and one reading.

    ``first`` says that the name fits the first pattern.  A file that is no
    image has null sizes and pixels.
    """
    found = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", f"{{{pattern},{other}}}").load(root)
    return decoded(found, keep_broken=True).select(
        _run_of(F.col("origin"), 2).alias("run_id"), frame_number(F.col("origin")).alias("frame_no"), _named(F.col("origin"), pattern).alias("first"), "height", "width", "px"
    )


def preferred(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Of ``files_as_frames`` those of the first pattern, and all of the other one where a run (one that isn't of ``runs``) has none."""
    return rows.join(runs.select("run_id", F.lit(True).alias("_has")).distinct(), "run_id", "left").filter(F.col("first") | F.col("_has").isNull()).drop("first", "_has")


def read_frames(spark: SparkSession, root: str, pattern: str = "frame*.png", other: str = "*.jpg") -> DataFrame:
    """Gray frames ``run_id, frame_no, height, width, px``; files that can't be decoded are left out.

    Runs without any file of the pattern give those of the ``other`` one, which
    a listing of names alone tells beforehand.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return preferred(files_as_frames(spark, root, pattern, other), names.select(_run_of(F.col("path"), 2).alias("run_id"))).filter("px is not null")


def broken_frames(spark: SparkSession, root: str, pattern: str = "frame*.png") -> DataFrame:
    """``run_id, frame_no`` of files that are no image."""
    found = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).filter("image.height < 0")
    return found.select(_run_of(F.col("image.origin"), 2).alias("run_id"), frame_number(F.col("image.origin")).alias("frame_no"))


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detections of files ``image,endpoint,beginning``: left and right bound of each frame."""
    rows = spark.read.schema("image string, endpoint int, beginning int").option("header", True).csv(path)
    return rows.withColumn("frame_no", frame_number(F.col("image")))
