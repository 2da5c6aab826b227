"""The folder that driver and executors share, and frames that are computed once into it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset and all run on one machine (tests), a folder of our own.

    Checkpoints in it are deleted when their frames are collected as garbage."""
    context = spark.sparkContext
    held = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not held:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        held = tempfile.mkdtemp(prefix="textloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(held)
    context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return held


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a path that scratch() gave, through Spark's own file system layer."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame) -> DataFrame:
    """df computed once: a reliable checkpoint in the shared folder, whose files go when the frame is collected as garbage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
