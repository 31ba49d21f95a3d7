"""Reading tables and keeping intermediate ones where every executor sees them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset and all run on this machine (tests), one of the session's own."""
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


def kept(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """The frame written to the shared folder and read again: lineage ends there, and a lost executor loses nothing.

    files: the most files that it is written as; the last stage has no more tasks than that.
    What drop_kept() has not removed by then goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # shuffle files go once the table is written
    try:
        (df if files is None else df.coalesce(files)).write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def drop_kept(*frames: DataFrame) -> None:
    """Removes the files of frames made by kept() that no plan needs any more."""
    for df in frames:
        files = df.inputFiles()
        if not files:
            continue
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
