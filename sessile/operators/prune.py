"""Dropping frames without a drop: by chunks, coarse to fine, and at both ends of a run.

Frames that ``frame_no`` orders are kept by ranges of it (``operators.ranges``),
so that pixels stay where they are.  Rows of another order, which hold no pixels,
are kept by a semi-join with the keys that stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.operators import ranges
from sessile.operators.arrow import KEY
from sessile.storage import materialize


def _placed(keys: DataFrame, skip: int, order: list[str]) -> DataFrame:
    """Keys with their place ``_n`` in the run, from 0, and its chunk."""
    numbered = keys.withColumn("_n", F.row_number().over(Window.partitionBy("run_id").orderBy(*order)) - 1)
    return numbered.withColumn("_chunk", F.floor(F.col("_n") / skip))


def _kept(placed: DataFrame, skip: int) -> DataFrame:
    """Keys of the chunks that have a hit, or are partial."""
    chunk = Window.partitionBy("run_id", "_chunk")
    ends = F.max(F.coalesce(F.col("_found"), F.lit(False)) & at_ends(skip, F.col("_n"))).over(chunk)
    return placed.withColumns({"_hit": ends, "_size": F.count("*").over(chunk)}).filter((F.col("_size") < skip) | F.col("_hit"))


def at_ends(skip: int, place: Column) -> Column:
    """Whether a detector has to see the frame at a place of the run."""
    return (place % skip).isin(0, skip - 1)


def prune_chunks(frames: DataFrame, skip: int, order: list[str], found: str = "found") -> DataFrame:
    """Frames but those of chunks of ``skip`` whose first and last frame have no drop; a last, partial chunk stays.

    Places count the frames that are still there; ``run_id`` and ``order`` name a frame.
    """
    return coarse_to_fine(frames, (skip,), order, found)


def coarse_to_fine(frames: DataFrame, skips: tuple[int, ...], order: list[str], found: str = "found") -> DataFrame:
    """Chunk pruning with each of ``skips`` in turn, places counted anew."""
    if order == ["frame_no"]:
        kept = materialize(ranges.stretches(frames.select(*KEY)), "kept")
        seen = frames.select(*KEY, F.coalesce(found, F.lit(False)).alias("found"))
        for skip in skips:
            kept = materialize(ranges.pruned(kept, skip, seen), "kept")
        return ranges.within(frames, kept)
    keys = frames.select("run_id", *order, F.col(found).alias("_found"))
    for skip in skips:
        keys = _kept(_placed(keys, skip, order), skip).select("run_id", *order, "_found")
    return frames.join(keys, ["run_id", *order], "left_semi")


def detected_ranges(frames: DataFrame, kept: DataFrame, skip: int, detect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The ranges that stay of ``kept``; ``detect`` gives ``run_id, frame_no, found`` and sees the ends of whole chunks alone."""
    ends = ranges.with_places(frames, kept).filter(ranges.at_chunk_ends(skip)).drop("_n", "_all")
    return materialize(ranges.pruned(kept, skip, materialize(detect(ends).select(*KEY, "found"), "seen")), "kept")


def prune_detecting(frames: DataFrame, skip: int, detect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``prune_chunks`` where ``detect`` looks at the ends of whole chunks alone."""
    return ranges.within(frames, detected_ranges(frames, materialize(ranges.stretches(frames.select(*KEY)), "kept"), skip, detect))


def entered(found: DataFrame, order: list[str], right_most: int = 1200, left_least: int = 40) -> DataFrame:
    """``run_id, head, tail``: the first row whose drop has come in (x2 < right_most) and the last before it goes (x1 > left_least)."""
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    head = F.min(F.when(F.col("found") & (F.col("x2") < right_most), at))
    tail = F.max(F.when(F.col("found") & (F.col("x1") > left_least), at))
    return found.groupBy("run_id").agg(head.alias("head"), tail.alias("tail"))


def trim(frames: DataFrame, order: list[str], right_most: int = 1200, left_least: int = 40, found: DataFrame | None = None) -> DataFrame:
    """Frames between ``entered``'s head and tail of their run; a run without such frames has none left.

    ``found`` has ``run_id``, the order columns, ``found``, ``x1`` and ``x2``, if
    ``frames`` itself has not.  No run is sorted.
    """
    ends = entered(frames if found is None else found, order, right_most, left_least)
    if order == ["frame_no"]:
        whole = ends.filter("head is not null and tail is not null").select("run_id", F.col("head").cast("long").alias("low"), F.col("tail").cast("long").alias("high"))
        return ranges.within(frames, whole.filter("low <= high"))
    at = F.struct(*order)
    return frames.join(ends, "run_id").filter((at >= F.col("head")) & (at <= F.col("tail"))).drop("head", "tail")
