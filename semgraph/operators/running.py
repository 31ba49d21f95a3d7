"""Running totals over a whole table without one task that sees all of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import own_folder


def ranged(df: DataFrame, order: Sequence[str], folder: str | None = None) -> DataFrame:
    """``df`` sorted into ranges of ``order`` (nulls first) and written once, with each row's range in ``_range``.

    The number of ranges follows spark.sql.shuffle.partitions, less where AQE
    finds them small.  folder: where the rows are written; by default one that
    goes with the session.
    """
    folder = folder or own_folder(df.sparkSession, "ranges")
    dealt = df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in order)).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(folder)
    return df.sparkSession.read.schema(dealt.schema).parquet(folder)


def running_totals(dealt: DataFrame, key: str, weights: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """A ``ranged`` frame with running sums of its weights (weight column to name) within each group of ``by``, in the order of ``key``.

    The frame was ranged by [*by, key]; keys are distinct within a group, a null
    one comes first.  A range is summed alone, and one row a group and range is
    added up and joined back, so a group of any size lies in many tasks.
    """
    by = list(by)
    sums = dealt.groupBy(*by, "_range").agg(*(F.sum(w).alias(f"_{name}") for w, name in weights.items()))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*by, "_range", *(F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}") for name in weights.values()))
    within = Window.partitionBy(*by, "_range").orderBy(F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    own = {name: F.sum(w).over(within) + F.col(f"_{name}") for w, name in weights.items()}
    return dealt.join(before, [*by, "_range"]).withColumns(own).drop("_range", *(f"_{name}" for name in weights.values()))


def running_total(df: DataFrame, key: str, weight: str, into: str = "upto") -> DataFrame:
    """``df`` with the sum of ``weight`` over all rows whose ``key`` is not larger; keys are distinct, a null one comes first."""
    return running_totals(ranged(df, [key]), key, {weight: into}).select(*df.columns, into)
