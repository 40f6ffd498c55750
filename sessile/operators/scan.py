"""Choosing runs and checking their frames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.operators import ranges
from sessile.operators.arrow import KEY, with_kernel, with_neighbours
from sessile.storage import materialize


def every_nth_run(runs: DataFrame, n: int = 5) -> DataFrame:
    """Every n-th run in the order of run_id.

    Runs are sorted by range over all tasks; each part learns how many runs lie
    before it from the counts of the parts, a row for each, and numbers its own.
    """
    parts = materialize(runs.repartitionByRange("run_id").sortWithinPartitions("run_id").withColumn("_part", F.spark_partition_id()), "runs")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("run_id")) - 1
    return parts.withColumn("_at", place).join(starts, "_part").filter((F.col("_start") + F.col("_at")) % n == 0).drop("_part", "_at", "_start")


def work_list(runs: DataFrame, status: DataFrame, done: tuple[str, ...] = ("done", "failed")) -> DataFrame:
    """Runs without a final status."""
    return runs.join(status.filter(F.col("status").isin(*done)).select("run_id").distinct(), "run_id", "left_anti")


def within_depth(files: DataFrame, root: str, most: int = 2) -> DataFrame:
    """Files at most ``most`` folders below ``root``, by their column ``path``."""
    below = F.expr(f"substring(path, {len(root.rstrip('/')) + 2})")
    return files.filter(F.col("path").startswith(root.rstrip("/") + "/") & (F.size(F.split(below, "/")) - 1 <= most))


def single_video(files: DataFrame) -> DataFrame:
    """``run_id, videos, ok``: a run needs exactly one video."""
    return files.groupBy("run_id").agg(F.count("*").alias("videos")).withColumn("ok", F.col("videos") == 1)


def odd_dimensions(videos: DataFrame, width: int = 1280, height: int = 120) -> DataFrame:
    """Videos of another size than expected."""
    return videos.filter((F.col("width") != width) | (F.col("height") != height))


def surface_check(frames: DataFrame, every: int = 4, bright: float = 100.0) -> DataFrame:
    """``run_id, checked, rejected``: of every 4th frame (by position) the mean of the last row, too bright in one rejects the run."""
    placed = ranges.with_places(frames.select(*KEY, "px", "height", "width"), materialize(ranges.stretches(frames.select(*KEY)), "runs"))
    means = with_kernel(placed.filter(F.col("_n") % every == 0), lambda a: (float(a[-1].mean()),), "mean double", keep=KEY)
    return means.groupBy("run_id").agg(F.count("*").alias("checked"), F.max(F.coalesce(F.col("mean") > bright, F.lit(False))).alias("rejected"))


def index_gaps(frames: DataFrame, index: str) -> DataFrame:
    """Rows before which indexes of the run are missing: run_id, index, previous, missing. Gaps are reported, not fatal."""
    before = F.lag(index).over(Window.partitionBy("run_id").orderBy(index))
    return frames.select("run_id", F.col(index), before.alias("previous")).withColumn("missing", F.col(index) - F.col("previous") - 1).filter("missing > 0")


def repaired(frames: DataFrame, broken: Column) -> DataFrame:
    """Frames with each broken one replaced by the mean of its neighbours in the run; null pixels without both."""

    def kernel(row: tuple, before: tuple | None, after: tuple | None, bad: bool | None) -> tuple:
        if not bad:
            return (row[0],)
        a, b = (None if x is None else x[0] for x in (before, after))
        if a is None or b is None or len(a) != len(b):
            return (None,)
        return (((np.frombuffer(a, np.uint8).astype(np.uint16) + np.frombuffer(b, np.uint8)) // 2).astype(np.uint8).tobytes(),)

    out = with_neighbours(frames, kernel, "px binary", broken, keep=[c for c in frames.columns if c != "px"], ahead=True)
    return out.select(*frames.columns)


def count_lines(files: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``lines`` and ``code_lines`` of a source text.

    Code is what is neither blank nor a comment nor within triple quotes; a line
    that holds triple quotes is never code, and an odd number of them opens or
    closes a block.  The lines are folded in place, row by row.
    """
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "\n$", "")
    lines = F.when(F.coalesce(F.col(text), F.lit("")) == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(body, "\n", -1))
    zero = F.struct(F.lit(0).alias("inside"), F.lit(0).cast("long").alias("code"))

    def step(acc: Column, line: Column) -> Column:
        quotes = (F.length(line) - F.length(F.replace(line, F.lit('"""'), F.lit("")))) / 3 + (F.length(line) - F.length(F.replace(line, F.lit("'''"), F.lit("")))) / 3
        bare = F.trim(line)
        code = (quotes == 0) & (acc["inside"] == 0) & (bare != "") & ~bare.startswith("#")
        return F.struct(((acc["inside"] + quotes) % 2).cast("int").alias("inside"), (acc["code"] + code.cast("long")).alias("code"))

    return files.withColumns({"lines": F.size(lines).cast("long"), "code_lines": F.aggregate(lines, zero, step, lambda a: a["code"])})
