"""Tables of the test data in the shape of frames, profiles and tracks.

They carry no physical meaning; they let SQL state what an operator must give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of 8 x 8 gray pixels, row by row: run_id, frame_no, width, height, px, and the same 64 values as the array ``v``, a profile."""
    gray = F.transform("embedding", lambda e: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((e.cast("double") + 0.5) * 255))).cast("int"))
    found = table(spark, sf_dir, "embeddings").select(F.col("label").alias("run_id"), F.col("vec_id").alias("frame_no"), F.lit(8).alias("width"), F.lit(8).alias("height"), gray.alias("v"))
    return found.withColumn("px", F.unhex(F.array_join(F.transform("v", lambda x: F.lpad(F.hex(x), 2, "0")), "")))


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per frame of a run: run_id, ts, event_id (their order), found, x_center, x1, x2."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        "ts",
        "event_id",
        F.col("event_type").isin("click", "purchase").alias("found"),
        F.col("value").alias("x_center"),
        F.floor(F.col("value") * 10).cast("long").alias("x1"),
        (F.floor(F.col("value") * 10) + F.col("event_id") % 700).cast("long").alias("x2"),
    )
