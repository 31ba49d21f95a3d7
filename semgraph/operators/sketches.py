"""Cardinalities and quantiles from stored sketches by column and file, which merge (OP-VALUES, AGG-01, AGG-15)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Bits of a HyperLogLog sketch's registers, and its relative standard error.
HLL_BITS, HLL_ERROR = 12, 1.04 / 64
#: Size of a quantile sketch, and the error of its ranks at 99 % confidence.
KLL_SIZE, KLL_ERROR = 200, 0.0133
KEYS = ["file_path", "file_size", "file_modification_time"]
STORED = "file_path string, file_size long, file_modification_time long, col_name string, n_rows long, n_values long, hll binary, kll binary"


def _file() -> list[Column]:
    """A row's file: path, size and time in microseconds."""
    return [F.col("_metadata.file_path").alias(KEYS[0]), F.col("_metadata.file_size").alias(KEYS[1]), F.unix_micros("_metadata.file_modification_time").alias(KEYS[2])]


def files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size, file_modification_time) of a table's files; only their listing is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(*_file())


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The sketches kept in ``folder``; none where it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(folder) if there else spark.createDataFrame([], STORED)


def refresh(spark: SparkSession, path: str, folder: str, columns: Sequence[str]) -> list[str]:
    """Sketches the files of the Parquet table at ``path`` that ``folder`` lacks, and gives their paths; no other file is read.

    A file counts as known by path, size and time, so a changed one is read
    again.  Each file gives one row a column: rows, values that are not null, a
    HyperLogLog sketch of their texts (whole numbers as such), and for numbers
    a quantile sketch (NaN has no place in it).  The driver holds the new
    files' paths.  A run that is cut off leaves nothing but a new folder
    without rows; of two runs at once both may sketch a file, which ``merged``
    takes once.
    """
    rows = files(spark, path).join(stored(spark, folder).select(*KEYS).distinct(), KEYS, "left_anti").collect()
    if not rows:
        return []
    new = [r["file_path"] for r in rows]
    df = spark.read.parquet(*new)
    kinds = {f.name: f.dataType for f in df.schema}

    def sketches(name: str) -> Column:
        c, number = F.col(f"`{name}`"), isinstance(kinds[name], NumericType)
        whole = kinds[name].typeName() in ("byte", "short", "integer", "long")
        hll = F.hll_sketch_agg(c.cast("long") if whole else c.cast("string"), HLL_BITS)
        kll = F.kll_sketch_agg_double(c.cast("double"), KLL_SIZE) if number else F.lit(None).cast("binary")
        return F.struct(F.lit(name).alias("col_name"), F.count("*").alias("n_rows"), F.count(c).alias("n_values"), hll.alias("hll"), kll.alias("kll"))

    by_file = df.groupBy(*_file()).agg(F.array(*(sketches(c) for c in columns)).alias("s"))
    found = by_file.select(*KEYS, F.explode("s").alias("s")).select(*KEYS, "s.*")
    # A file without rows is known by empty figures, or it would be new each time.
    every = spark.createDataFrame(rows, "file_path string, file_size long, file_modification_time long").withColumn("col_name", F.explode(F.array(*map(F.lit, columns))))
    every.join(found, [*KEYS, "col_name"], "left").fillna(0, ["n_rows", "n_values"]).write.parquet(f"{folder}/{uuid.uuid4().hex}")
    return new


def merged(spark: SparkSession, path: str, folder: str, ranks: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 0.95, 1.0)) -> DataFrame:
    """(col_name, n_rows, n_values, card, quantiles) over the files that the table has now, from their sketches alone.

    card is 0 without values; quantiles are null where a column has no numbers.  Files that went or changed don't count; files that
    were not sketched yet are not in the figures: call ``refresh`` first.
    """
    known = stored(spark, folder).dropDuplicates([*KEYS, "col_name"])
    live = known.join(files(spark, path), KEYS, "left_semi").groupBy("col_name")
    sums = live.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("hll")), F.lit(0)).alias("card"), F.kll_merge_agg_double("kll").alias("k"))
    some = F.col("k").isNotNull() & (F.kll_sketch_get_n_double("k") > 0)
    quantiles = F.array(*(F.kll_sketch_get_quantile_double("k", F.lit(float(p))) for p in ranks))
    return sums.select("col_name", "n_rows", "n_values", "card", F.when(some, quantiles).alias("quantiles"))
