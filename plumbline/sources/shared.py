"""Intermediate tables in the folder that the driver and all executors share, so that lost executors lose no work."""

from __future__ import annotations

import gc
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only by a local master, where driver and executors are one process.
LOCAL_DIR = "/tmp/checkpoints"


def folder(spark: SparkSession) -> str:
    """This application's own folder below spark.checkpoint.dir. It is deleted when the driver ends.

    Without that setting a cluster has no folder that every executor sees: an error, except on a local master.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or LOCAL_DIR)
    path = spark._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder, so lost executors lose no work and no lineage is replayed."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes a shuffle's files when the driver's garbage collection finds that nothing refers to it: after a large cut, that is now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read again: compressed, and with columns that later plans can prune."""
    spark = df.sparkSession
    path = f"{folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
