"""Operators over streams of frames; a run's state is one integer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sessile.operators.detect import fold_widths, steps


def _fold(width: int, growth: float):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get[0] if state.exists else width
        rows = pd.concat(list(batches)).sort_values("frame_no")
        values = rows[["near", "far", "end"]].astype(float).to_numpy()
        endpoints, widths, now = fold_widths(values, now, growth)
        state.update((now,))
        whole = lambda v: pd.Series(v, dtype=float).round().astype("Int64")
        yield pd.DataFrame({"run_id": key[0], "frame_no": rows["frame_no"].to_numpy(), "endpoint": whole(endpoints), "beginning": whole(values[:, 2]), "width": widths})

    return run


def stream_bounds(frames: DataFrame, profile: str, steep: float, steep_wide: float, width: int, growth: float) -> DataFrame:
    """``detect.adaptive_bounds`` over a stream: the guard of each run is kept from batch to batch.

    Frames of a run have to arrive in order between batches; within one they are sorted.
    """
    found = steps(frames, profile, profile, steep, steep_wide).select("run_id", "frame_no", "near", "far", "end")
    types = dict(frames.dtypes)
    schema = f"run_id {types['run_id']}, frame_no {types['frame_no']}, endpoint int, beginning int, width int"
    return found.groupBy("run_id").applyInPandasWithState(_fold(width, growth), schema, "width int", "append", GroupStateTimeout.NoTimeout)


def found_per_window(track: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """``run_id, start, frames, found``: how many frames of a run show a drop, by window of ``ts``; later rows than ``late`` are dropped."""
    counts = track.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy("run_id", F.window("ts", window)).agg(F.count("*").alias("frames"), F.count_if("found").alias("found"))
    return counts.select("run_id", F.col("window.start").alias("start"), "frames", "found")
