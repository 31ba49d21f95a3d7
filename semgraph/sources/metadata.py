"""Catalog metadata as frames (SRC-01..07, SRC-17, SRC-18).

A provider stands for ``information_schema``: it lists schemata, tables and
columns from a directory of parquet tables, from Spark's catalog, or from rows.
Only names and types are handled on the driver, never table data.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

INTERNAL = ("information_schema", "default")


@dataclass(frozen=True)
class Snapshot:
    """Schemata, tables and columns of one or more catalogs."""

    schemata: DataFrame
    tables: DataFrame
    columns: DataFrame


def strip_prefix(table: str, column: str) -> str:
    """A logical name without a table's one or two-letter prefix, as in ``c_custkey``."""
    return re.sub(rf"^(?:{re.escape(table[0])}|{re.escape(table[:2])})_", "", column)


def table_names(spark: SparkSession, directory: str) -> list[str]:
    """Names of ``*.parquet`` below a directory that Spark can read, wherever it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def from_directory(spark: SparkSession, directory: str, catalog: str = "lake", schema: str = "main", rename: Callable[[str, str], str] = lambda table, column: column) -> Snapshot:
    """A snapshot of the parquet tables in a directory; only their footers are read."""
    names = table_names(spark, directory)
    columns = [
        (catalog, schema, name, rename(name, f.name), f.dataType.simpleString().upper(), "YES" if f.nullable else "NO", i + 1, None)
        for name in names
        for i, f in enumerate(spark.read.parquet(f"{directory}/{name}.parquet").schema.fields)
    ]
    tables = [(catalog, schema, name, "EXTERNAL", None, None, None) for name in names]
    return Snapshot(spark.createDataFrame([(catalog, schema, None)], S.SCHEMATA), spark.createDataFrame(tables, S.TABLES), spark.createDataFrame(columns, S.COLUMNS))


def from_session(spark: SparkSession, databases: Iterable[str] | None = None) -> Snapshot:
    """A snapshot of the tables in Spark's own catalog (SRC-18: internal schemas are left out)."""
    catalog = spark.catalog.currentCatalog()
    found = [d for d in spark.catalog.listDatabases() if (databases is None and d.name not in INTERNAL) or (databases and d.name in databases)]
    tables = [(d.name, t) for d in found for t in spark.catalog.listTables(d.name) if not t.isTemporary]
    columns = [
        (catalog, d, t.name, c.name, c.dataType.upper(), "YES" if c.nullable else "NO", i + 1, c.description)
        for d, t in tables
        for i, c in enumerate(spark.catalog.listColumns(f"{d}.{t.name}"))
    ]
    return Snapshot(
        spark.createDataFrame([(catalog, d.name, d.description) for d in found], S.SCHEMATA),
        spark.createDataFrame([(catalog, d, t.name, t.tableType, t.description, None, None) for d, t in tables], S.TABLES),
        spark.createDataFrame(columns, S.COLUMNS),
    )


def scoped(snapshot: Snapshot, schemas: list[str] | None = None) -> Snapshot:
    """SRC-01..03, FLT-01: without information_schema, and of ``schemas`` only if any are given."""

    def keep(df: DataFrame, column: str) -> DataFrame:
        df = df.where(F.lower(column) != "information_schema")
        return df.where(F.col(column).isin(schemas)) if schemas else df

    return Snapshot(keep(snapshot.schemata, "schema_name"), keep(snapshot.tables, "table_schema"), keep(snapshot.columns, "table_schema"))


def key_constraints(table_constraints: DataFrame, key_column_usage: DataFrame) -> DataFrame:
    """SRC-04, JOIN-06: a row for each column of each primary key or unique constraint."""
    keys = ["constraint_catalog", "constraint_schema", "constraint_name"]
    wanted = table_constraints.where(F.col("constraint_type").isin("PRIMARY KEY", "UNIQUE")).select(*keys, "constraint_type")
    return key_column_usage.join(wanted, keys).select("table_catalog", "table_schema", "table_name", "column_name", "constraint_type", "ordinal_position", "constraint_name")


def declared_pairs(referential: DataFrame, key_column_usage: DataFrame) -> DataFrame:
    """SRC-05, JOIN-07: column pairs of declared foreign keys, each with its place in the key that it refers to."""
    src, tgt = key_column_usage.alias("src"), key_column_usage.alias("tgt")
    rc = referential.alias("rc")
    on_src = (F.col("rc.constraint_catalog") == F.col("src.constraint_catalog")) & (F.col("rc.constraint_schema") == F.col("src.constraint_schema")) & (F.col("rc.constraint_name") == F.col("src.constraint_name"))
    on_tgt = (
        (F.col("rc.unique_constraint_catalog") == F.col("tgt.constraint_catalog"))
        & (F.col("rc.unique_constraint_schema") == F.col("tgt.constraint_schema"))
        & (F.col("rc.unique_constraint_name") == F.col("tgt.constraint_name"))
        & (F.col("tgt.ordinal_position") == F.col("src.position_in_unique_constraint"))
    )
    names = {f"{a}_{b}": f"{a}.{'table_' if b in ('catalog', 'schema') else ''}{b if b in ('catalog', 'schema') else b + '_name'}" for a in ("src", "tgt") for b in ("catalog", "schema", "table", "column")}
    return rc.join(src, on_src).join(tgt, on_tgt).select(
        F.col("rc.constraint_schema").alias("fk_schema"), F.col("rc.constraint_name").alias("fk_name"), *(F.col(path).alias(name) for name, path in names.items()), F.col("src.ordinal_position").alias("ord")
    )


def readable_schemas(candidates: dict[str, list[Callable[[], DataFrame]]], probes: int = 3) -> list[str]:
    """SRC-07: schemas of which one of the first few tables can be read; a schema goes only if all probes fail."""

    def works(read: Callable[[], DataFrame]) -> bool:
        try:
            read().limit(1).take(1)
        except (AnalysisException, PySparkException):
            return False
        return True

    return [schema for schema, reads in candidates.items() if not reads or any(works(r) for r in reads[:probes])]


def listed_catalogs(lists: DataFrame, listed: str, by: list[str]) -> DataFrame:
    """SET-06: (by.., position, catalog, layer) of each row's list ``a:layer,b``: first occurrences in order; null and blank lists have none."""
    items = lists.select(*by, F.posexplode(F.split(listed, ",")).alias("position", "item"))
    layer = F.when(F.contains("item", F.lit(":")), F.trim(F.substring_index("item", ":", -1)))
    parts = items.select(*by, "position", F.trim(F.substring_index("item", ":", 1)).alias("catalog"), layer.alias("layer")).where("catalog <> ''")
    first = parts.groupBy(*by, "catalog").agg(F.min(F.struct("position", "layer")).alias("first"))
    return first.select(*by, "first.position", "catalog", "first.layer")


def resolve_catalogs(spark: SparkSession, catalog: str, catalogs: str) -> DataFrame:
    """SET-06: the catalogs of one list, or the one catalog if the list is blank."""
    if not catalogs.strip():
        return spark.range(1).select(F.lit(0).alias("position"), F.lit(catalog).alias("catalog"), F.lit(None).cast("string").alias("layer"))
    return listed_catalogs(spark.range(1).select(F.lit(catalogs).alias("listed")), "listed", [])
