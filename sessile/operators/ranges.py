"""Frames of a run as ranges of frame numbers, made, cut and joined without moving pixels.

A range is ``run_id, low, high``, both ends included.  A run without gaps is one
range, and what pruning keeps of it are a few, so that tables of ranges are
small: they are written, their rows counted, and up to a bound they are
broadcast to the frames.  Only where there are more, frames are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.operators.arrow import KEY
from sessile.storage import materialize

#: Frame numbers of a block: a frame meets the ranges of its block alone.
BLOCK = 4096
#: Ranges, cut by block, that are broadcast at most (some 40 bytes each).
MOST = 1_000_000


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf = pdf.drop_duplicates().sort_values(KEY)
        if len(pdf):
            no = pdf["frame_no"].to_numpy(np.int64)
            new = np.r_[True, (pdf["run_id"].to_numpy()[1:] != pdf["run_id"].to_numpy()[:-1]) | (no[1:] > no[:-1] + 1)]
            starts = np.flatnonzero(new)
            yield pd.DataFrame({"run_id": pdf["run_id"].to_numpy()[starts], "low": no[starts], "high": no[np.r_[starts[1:], len(no)] - 1]})


def merged(ranges: DataFrame) -> DataFrame:
    """Ranges that overlap or follow each other as one."""
    order = Window.partitionBy("run_id").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(reach.isNull() | (F.col("low") > reach + 1), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return ranges.withColumn("_island", island).groupBy("run_id", "_island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_island")


def stretches(keys: DataFrame) -> DataFrame:
    """The ranges of consecutive frame numbers that ``keys`` (run_id, frame_no) fill.

    Each batch of rows gives its own first, so that few rows are merged.
    """
    run_type = dict(keys.dtypes)["run_id"]
    parts = keys.select("run_id", F.col("frame_no").cast("long").alias("frame_no")).mapInPandas(_stretches, f"run_id {run_type}, low long, high long")
    return merged(parts)


def placed(ranges: DataFrame) -> DataFrame:
    """``ranges`` with ``place``, the number of the run's frames before each, and ``all``, that of all its frames."""
    size = F.col("high") - F.col("low") + 1
    order = Window.partitionBy("run_id").orderBy("low")
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranges.withColumns({"place": before, "all": F.sum(size).over(Window.partitionBy("run_id"))})


def of_places(ranges: DataFrame, places: DataFrame) -> DataFrame:
    """The ranges of frame numbers at the ``places`` (run_id, first, last) of the run that ``ranges`` describes."""
    both = placed(ranges).join(places, "run_id")
    low = F.col("low") + F.greatest(F.col("first") - F.col("place"), F.lit(0))
    high = F.least(F.col("high"), F.col("low") + F.col("last") - F.col("place"))
    return both.select("run_id", low.alias("low"), high.alias("high")).filter("low <= high")


def _cut(ranges: DataFrame) -> DataFrame:
    """Ranges cut at the borders of blocks."""
    block = lambda c: F.floor(F.col(c) / BLOCK)
    return ranges.withColumn("_block", F.explode(F.sequence(block("low"), block("high"))))


def within(frames: DataFrame, ranges: DataFrame, *columns: str, how: str = "inner", most: int = MOST) -> DataFrame:
    """``frames`` whose number lies in one of ``ranges``, which don't overlap, with their ``columns``; all frames if ``how`` is "left"."""
    cut = materialize(_cut(ranges).select(F.col("run_id").alias("_run"), "_block", "low", "high", *columns), "ranges")
    number = F.col("frame_no")
    here = (frames["run_id"] == F.col("_run")) & (F.floor(number / BLOCK) == F.col("_block")) & (number >= F.col("low")) & (number <= F.col("high"))
    cut = F.broadcast(cut) if cut.count() <= most else cut.hint("merge")
    return frames.join(cut, here, how).drop("_run", "_block", "low", "high")


def clipped(ranges: DataFrame, ends: DataFrame) -> DataFrame:
    """``ranges`` between ``head`` and ``tail`` of their run; runs without both have none left."""
    both = ranges.join(ends.filter("head is not null and tail is not null"), "run_id")
    return both.select("run_id", F.greatest("low", "head").alias("low"), F.least("high", "tail").alias("high")).filter("low <= high")


def with_places(frames: DataFrame, ranges: DataFrame) -> DataFrame:
    """``frames`` in ``ranges`` with their place ``_n`` in the run, from 0, and the number ``_all`` of its frames."""
    starts = placed(ranges).select("run_id", "low", "high", (F.col("place") - F.col("low")).alias("_shift"), F.col("all").alias("_all"))
    return within(frames, starts, "_shift", "_all").withColumn("_n", F.col("frame_no") + F.col("_shift")).drop("_shift")


def at_chunk_ends(skip: int) -> Column:
    """Whether a placed frame is the first or the last one of a whole chunk."""
    place, whole = F.col("_n") % skip, F.floor(F.col("_n") / skip) * skip + skip <= F.col("_all")
    return whole & place.isin(0, skip - 1)


def pruned(ranges: DataFrame, skip: int, found: DataFrame) -> DataFrame:
    """The ranges that are left without the chunks of ``skip`` frames in whose first and last frame nothing is ``found``
    (run_id, frame_no, found); a last, partial chunk stays.  Places count the frames of ``ranges``."""
    hits = with_places(found.filter("found").select(*KEY), ranges).filter(at_chunk_ends(skip)).select("run_id", F.floor(F.col("_n") / skip).alias("chunk")).distinct()
    rest = placed(ranges).select("run_id", "all").distinct().filter(F.col("all") % skip > 0).select("run_id", F.floor(F.col("all") / skip).alias("chunk"))
    chunks = hits.unionByName(rest).select("run_id", (F.col("chunk") * skip).alias("low"), (F.col("chunk") * skip + skip - 1).alias("high"))
    places = merged(chunks).select("run_id", F.col("low").alias("first"), F.col("high").alias("last"))
    return merged(of_places(ranges, places))
