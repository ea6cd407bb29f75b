"""Written cuts of the lineage, under the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  Where it is unset, a temporary folder, but only in local mode, where all tasks run on this machine; the session's settings stay as they are."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="ledgermatch-"))
            atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
        where = _local[0]
    return where.rstrip("/") if "://" in where else "file://" + where.rstrip("/")


def path_for(spark: SparkSession, name: str) -> str:
    """A new path of its own under the shared folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(frame: DataFrame, name: str) -> DataFrame:
    """Writes the rows and reads them back, so that a plan that uses them several times computes them once, and lost executors lose nothing.  ``release`` deletes the table."""
    spark, path = frame.sparkSession, path_for(frame.sparkSession, name)
    frame.write.parquet(path)
    made = spark.read.schema(frame.schema).parquet(path)
    made.scratch_at = path
    return made


def release(*frames: DataFrame) -> None:
    """Deletes tables that ``cut`` wrote, when nothing that is still to run reads them."""
    for frame in frames:
        if path := getattr(frame, "scratch_at", None):
            spark = frame.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
