"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only where it is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="caseloom-"))
    return context.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark writes to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace(spark: SparkSession, new: str, old: str) -> None:
    """Put a folder in the place of another one of the same store; where the new one does not exist, the old one only goes."""
    to = spark._jvm.org.apache.hadoop.fs.Path(old)
    folder, moved = to.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path(new)
    folder.delete(to, True)
    if folder.exists(moved) and not folder.rename(moved, to):
        raise OSError(f"{new} was not moved to {old}")
