"""What a run leaves behind: tables of detections and results, edge points, errors, status, manifests."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessile.operators.arrow import KEY, pixels
from sessile.schemas import RESULT_NAMES


def _by_run(df: DataFrame):
    """A writer whose runs replace their own earlier rows alone."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")


def write_detections(detections: DataFrame, path: str) -> None:
    """One partition for each run; a run that is done again replaces its own alone."""
    _by_run(detections).parquet(path)


def write_points(points: DataFrame, path: str) -> None:
    """Ordered edge points, ``run_id, frame_no, ord, x, y``."""
    _by_run(points).parquet(path)


def result_series(series: DataFrame) -> DataFrame:
    """The time series under the column names of result files."""
    return series.select("run_id", *[F.col(c).alias(name) for c, name in RESULT_NAMES.items()])


def write_results(series: DataFrame, path: str) -> None:
    _by_run(result_series(series)).option("header", True).csv(path)


def wipe(df: DataFrame, path: str) -> None:
    """Replace a whole table, whatever runs it held."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("run_id").parquet(path)


def errors(rows: DataFrame, stage: str) -> DataFrame:
    """Error rows of a stage: those with an ``error_class``, with their ``message`` (if there is one) and the time ``ts``."""
    message = F.col("message") if "message" in rows.columns else F.lit(None).cast("string")
    return rows.filter("error_class is not null").select("run_id", "frame_no", F.lit(stage).alias("stage"), "error_class", message.alias("message"), F.current_timestamp().alias("ts"))


def run_status(rows: DataFrame) -> DataFrame:
    """``run_id, frames, failed, status, finished_at`` of every run: done, done_with_errors, or failed where no frame succeeded."""
    out = rows.groupBy("run_id").agg(F.count("*").alias("frames"), F.count("error_class").alias("failed"))
    status = F.when(F.col("failed") == F.col("frames"), "failed").when(F.col("failed") > 0, "done_with_errors").otherwise("done")
    return out.withColumns({"status": status, "finished_at": F.current_timestamp()})


def manifest(frames: DataFrame, order: list[str]) -> DataFrame:
    """Files of every run with their place ``ord`` from 0, for an encoder outside."""
    return frames.withColumn("ord", F.row_number().over(Window.partitionBy("run_id").orderBy(*order)) - 1)


class Emitter(Protocol):
    """What takes frames with their bounds one after another, and may have something left at the end; made once for each task."""

    def forward(self, key: tuple, image: np.ndarray, endpoint: int, beginning: int) -> list[tuple]: ...

    def finish(self) -> list[tuple]: ...


def emitted(frames: DataFrame, make: Callable[[], Emitter], schema: str) -> DataFrame:
    """Rows that an emitter gives for frames with ``endpoint`` and ``beginning``; frames without bounds aren't shown to it."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        emitter = make()
        for pdf in batches:
            rows = []
            for run_id, no, p, h, w, a, b in pdf.itertuples(index=False):
                image = pixels(p, h, w)
                if image is not None:
                    rows += emitter.forward((run_id, no), image, int(a), int(b))
            yield pd.DataFrame(rows, columns=names)
        yield pd.DataFrame(emitter.finish(), columns=names)

    given = frames.filter("endpoint is not null and beginning is not null").select(*KEY, "px", "height", "width", "endpoint", "beginning")
    return given.mapInPandas(run, schema)
