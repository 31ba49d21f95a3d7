"""Tables between steps, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset and all runs on this machine (tests), a folder of the session's own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        held = context._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not context._jsc.sc().isLocal():
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            context.setCheckpointDir(f"/tmp/checkpoints/{uuid.uuid4().hex}")
            held = context._jsc.sc().getCheckpointDir()
        root = held.get()
    return root.rstrip("/")


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path; what is in it goes when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written and read again: its lineage ends there."""
    path = own_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
