"""Which stage of which run is done: an analysis that a lost driver can take up again.

Every stage writes its rows by run and enters the run in the ledger only after
that.  A later driver asks the ledger what is left: a run goes through those
stages alone that it hasn't been entered for, and what an earlier attempt left
half written is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessile.config import Settings
from sessile.operators import detect, fit, kinematics, ranges, scan
from sessile.plans import analysis
from sessile.storage import exists, materialize

#: Name of a stage, and what it makes of the tables before it, by their names.
Stage = tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]


class Ledger:
    """Rows ``run_id, stage, attempt, status, at`` in a folder that all drivers share; nothing is ever changed in it."""

    def __init__(self, spark: SparkSession, path: str, run_type: str = "string") -> None:
        self.spark, self.path = spark, path
        self.schema = f"run_id {run_type}, stage string, attempt int, status string, at timestamp"

    def rows(self) -> DataFrame:
        if exists(self.spark, self.path):
            return self.spark.read.schema(self.schema).parquet(self.path)
        return self.spark.createDataFrame([], self.schema)

    def todo(self, runs: DataFrame, stage: str) -> DataFrame:
        """Those of ``runs`` that the stage isn't done for."""
        return scan.work_list(runs.select("run_id").distinct(), self.rows().filter(F.col("stage") == stage).select("run_id", "status"), ("done",))

    def _enter(self, rows: DataFrame, stage: str, status: str) -> None:
        rows.select("run_id", F.lit(stage).alias("stage"), "attempt", F.lit(status).alias("status"), F.current_timestamp().alias("at")).coalesce(1).write.mode("append").parquet(self.path)

    def begin(self, runs: DataFrame, stage: str) -> DataFrame:
        """Enters a new attempt at the stage for each of ``runs``: ``run_id, attempt``, written."""
        before = self.rows().filter(F.col("stage") == stage).groupBy("run_id").agg(F.max("attempt").alias("last"))
        tried = runs.join(before, "run_id", "left").select("run_id", (F.coalesce("last", F.lit(0)) + 1).cast("int").alias("attempt"))
        tried = materialize(tried, "attempt")
        self._enter(tried, stage, "begun")
        return tried

    def commit(self, tried: DataFrame, stage: str) -> None:
        self._enter(tried, stage, "done")


def staged(tables: dict[str, DataFrame], runs: DataFrame, stages: list[Stage], root: str) -> dict[str, DataFrame]:
    """``tables`` and the result of each stage, for all ``runs``; below ``root`` lie the ledger and a folder for each stage.

    A stage sees the rows of those runs alone that it isn't done for; its
    result has ``run_id``.  Stages without open runs aren't called.
    """
    spark, run_type = runs.sparkSession, dict(runs.dtypes)["run_id"]
    ledger, out = Ledger(spark, f"{root}/ledger", run_type), dict(tables)
    for name, stage in stages:
        path, todo = f"{root}/{name}", materialize(ledger.todo(runs, name), "todo")
        n = todo.count()
        if n:
            tried = ledger.begin(todo, name)
            few = F.broadcast(todo) if n <= ranges.MOST else todo.hint("merge")
            rows = stage({k: t.join(few, "run_id", "left_semi") for k, t in out.items()})
            columns = [c for c in rows.columns if c != "run_id"]
            rows.select(*columns, "run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
            spark.createDataFrame([(rows.select(*columns, "run_id").schema.json(),)], "json string").coalesce(1).write.mode("overwrite").text(f"{root}/schema-{name}")
            ledger.commit(tried, name)
        schema = _schema(spark, f"{root}/schema-{name}")
        out[name] = spark.read.schema(schema).parquet(path)
    return out


def _schema(spark: SparkSession, path: str):
    import json

    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads("".join(r.value for r in spark.read.text(path).collect())))


def analysis_stages(cfg: Settings = Settings(), margin: int = 4, make: Callable[[], detect.Detector] | None = None, level: bool = True, fits: fit.TwoPass = fit.TwoPass()) -> list[Stage]:
    """The stages of ``analysis.analysed`` over the table ``raw``."""
    return [
        ("surfaces", lambda t: analysis.surfaces(t["raw"], cfg, level)),
        ("levelled", lambda t: analysis.looked_at(analysis.of_runs(t["raw"], t["surfaces"]), cfg, level)),
        ("used", lambda t: analysis.drop_ranges(t["levelled"], make, cfg)),
        ("measured", lambda t: analysis.crops_measured(analysis.bounded(t["levelled"], t["used"], cfg), margin, cfg, fits)),
    ]


def resumed(raw: DataFrame, root: str, cfg: Settings = Settings(), **options) -> tuple[DataFrame, DataFrame]:
    """``analysis.analysed``, taken up where the last driver with this ``root`` left it."""
    rows = staged({"raw": raw}, raw.select("run_id").distinct(), analysis_stages(cfg, **options), root)["measured"]
    series = kinematics.kinematics(rows.filter("error_class is null"), ["frame_no"], cfg.fps_experiment, index=F.col("frame_no"))
    return series, rows
