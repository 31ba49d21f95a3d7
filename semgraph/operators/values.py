"""Sampling of distinct column values (OP-VALUES)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.ids import dotted_id, value_id
from .nodes import balanced_union
from .running import running_total


def sampleable(columns: DataFrame, types: tuple[str, ...] = ("STRING", "BOOLEAN")) -> DataFrame:
    """FLT-02, AGG-03: the sampled columns of each table, by name (SRT-01: tables in order)."""
    return columns.where(F.col("data_type").isin(*types)).groupBy("table_catalog", "table_schema", "table_name").agg(F.array_sort(F.collect_list("column_name")).alias("columns"))


def cardinalities(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """AGG-01: (col_name, card) of many columns in one scan, approximate or exact."""
    count = F.count_distinct if exact else F.approx_count_distinct
    wide = df.agg(*(count(F.col(c)).alias(c) for c in columns))
    return wide.select(F.expr(f"stack({len(columns)}, " + ", ".join(f"'{c}', `{c}`" for c in columns) + ") as (col_name, card)"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """EXP-01, AGG-02, FLT-03: how often each value that is neither null nor empty occurs, as text, in one scan."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    return df.select(F.expr(f"stack({len(columns)}, {pairs}) as (col_name, val)")).where("val is not null and val <> ''").groupBy("col_name", "val").agg(F.count("*").alias("cnt"))


def top_values(counts: DataFrame, limit: int = 10, by: str = "col_id") -> DataFrame:
    """WIN-03: the most frequent values of each column, ties to the smaller value."""
    order = Window.partitionBy(by).orderBy(F.desc("cnt"), F.asc("val"))
    return counts.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= limit)


def sample(tables: dict[tuple[str, str, str], tuple[DataFrame, list[str]]], limit: int = 10, threshold: int = 50, chunk: int = 50, exact: bool = False, batch: int = 64) -> DataFrame:
    """OP-VALUES: (col_id, col_name, val, cnt, tbl_catalog, tbl_schema, tbl_name) of columns with fewer than ``threshold`` values.

    A table's columns are read ``chunk`` at a time.  Cardinalities come first,
    so that columns of many values are never grouped; those of ``batch`` chunks
    are one job.
    """
    scans = [(name, df, columns[lo : lo + chunk]) for name, (df, columns) in tables.items() for lo in range(0, len(columns), chunk)]
    parts = []
    for first in range(0, len(scans), batch):
        some = scans[first : first + batch]
        counted = [cardinalities(df.select(*columns), columns, exact).where(F.col("card") < threshold).select(F.lit(i).alias("scan"), "col_name") for i, (_, df, columns) in enumerate(some)]
        # A row for each column at most reaches the driver.
        few: dict[int, list[str]] = {}
        for r in balanced_union(counted).collect():
            few.setdefault(r["scan"], []).append(r["col_name"])
        for i, columns in sorted(few.items()):
            (catalog, schema, name), df, _ = some[i]
            parts.append(value_counts(df.select(*columns), columns).withColumns({"tbl_catalog": F.lit(catalog), "tbl_schema": F.lit(schema), "tbl_name": F.lit(name)}))
    if not parts:
        return next(iter(tables.values()))[0].sparkSession.createDataFrame([], S.SAMPLED)
    named = balanced_union(parts).withColumn("col_id", dotted_id("tbl_catalog", "tbl_schema", "tbl_name", "col_name"))
    return top_values(named, limit).select("col_id", "col_name", "val", "cnt", "tbl_catalog", "tbl_schema", "tbl_name")


def value_nodes(sampled: DataFrame, last_run) -> DataFrame:
    """PRJ-02, AGG-22: a node for each value id; last_run stamps them for the removal of stale ones."""
    nodes = sampled.select(
        value_id("col_id", "val").alias("id"), F.col("val").alias("value"), F.col("cnt").alias("count"), F.col("tbl_catalog").alias("catalog"), F.col("tbl_schema").alias("schema"),
        F.lit(last_run).alias("last_run"), F.lit(S.CONTRACT_VERSION).alias("contract_version"),
    )
    return nodes.dropDuplicates(["id"])


def nearest_ranks(df: DataFrame, column: str) -> DataFrame:
    """AGG-15: min, p25, p50, p75, p95, max by nearest rank round(p * (n - 1)), halves to even."""
    # Values are counted first, so the running total is over distinct values, not rows.
    counts = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    ranked = running_total(counts, "v", "c").join(F.broadcast(df.agg(F.count("*").alias("n"))))  # one row
    quantiles = [("min", 0.0), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95), ("max", 1.0)]

    def at(p: float):
        rank = F.bround(F.lit(p) * (F.col("n") - 1)).cast("long")
        return F.min(F.when(F.col("upto") > rank, F.col("v")))

    return ranked.agg(*(at(p).alias(name) for name, p in quantiles))
