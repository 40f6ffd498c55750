"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a session on one machine (master ``local``) that lacks the setting, as
    in tests, gets a folder of its own; on a cluster that is an error, as
    executors would each write to a disk that the others can't read.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir has to name a folder that all executors share (master {master})")
        found = "file://" + tempfile.mkdtemp(prefix="sessile-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


#: Whether the shuffle files of a query go as soon as it has ended.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, by: str | None = None, free: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder, in a folder for each value of column ``by``, and read it back.

    It cuts the lineage as ``checkpoint()`` does, but computes ``df`` once and
    survives lost executors.  The files go with ``discard``, at the latest when
    the driver's JVM ends.  With ``free``, the shuffle files behind ``df`` go once
    it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE)
    if free:
        spark.conf.set(_FREE, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.set(_FREE, before)
    place, files = _file_system(spark, path)
    files.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that nothing will read again."""
    for table in tables:
        place, files = _file_system(table.sparkSession, table.written_to)
        files.delete(place, True)
