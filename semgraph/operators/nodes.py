"""Nodes and structural edges of the graph (PRJ-03..13, SET-01)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.ids import dotted_id
from ..functions.text import comment_tokens
from ..functions.types import canonical_type


def balanced_union(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-01: unionByName of all frames as a tree whose depth is the logarithm of their number."""
    if not frames:
        raise ValueError("no frames to unite")
    frames = list(frames)
    while len(frames) > 1:
        pairs = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2], strict=False)]
        frames = pairs + frames[len(pairs) * 2 :]
    return frames[0]


def _version(df: DataFrame) -> DataFrame:
    return df.withColumn("contract_version", F.lit(S.CONTRACT_VERSION))


def database_nodes(schemata: DataFrame) -> DataFrame:
    """PRJ-03: a node for each catalog."""
    return _version(schemata.select("catalog_name").distinct().select(dotted_id("catalog_name").alias("id"), F.col("catalog_name").alias("name"))).withColumn("embedding_text", F.expr(S.EMBEDDING_TEXT["Database"]))


def schema_nodes(schemata: DataFrame) -> DataFrame:
    """PRJ-04."""
    named = schemata.select(dotted_id("catalog_name", "schema_name").alias("id"), F.col("schema_name").alias("name"), "comment", "catalog_name")
    return _version(named.withColumn("embedding_text", F.expr(S.EMBEDDING_TEXT["Schema"]))).drop("catalog_name")


def table_nodes(tables: DataFrame, layers: dict[str, str] | None = None) -> DataFrame:
    """PRJ-05: layer is what ``layers`` says of the table's catalog; null where it says nothing."""
    layer: Column = F.lit(None).cast("string")
    for catalog, name in (layers or {}).items():
        layer = F.when(F.col("table_catalog") == catalog, name).otherwise(layer)
    named = tables.withColumn("name", F.col("table_name")).withColumn("embedding_text", F.expr(S.EMBEDDING_TEXT["Table"]))
    return _version(
        named.select(
            dotted_id("table_catalog", "table_schema", "table_name").alias("id"), "name", F.col("table_catalog").alias("catalog"), F.col("table_schema").alias("schema"),
            layer.alias("layer"), "comment", "table_type", "created", "last_altered", "embedding_text",
        )
    )


def column_nodes(columns: DataFrame) -> DataFrame:
    """PRJ-06: is_nullable is true for YES, false for NO, null for anything else."""
    named = columns.withColumn("name", F.col("column_name")).withColumn("embedding_text", F.expr(S.EMBEDDING_TEXT["Column"]))
    return _version(
        named.select(
            dotted_id("table_catalog", "table_schema", "table_name", "column_name").alias("id"), "name", F.col("table_catalog").alias("catalog"), F.col("table_schema").alias("schema"),
            F.col("table_name").alias("table"), "data_type", F.when(F.col("is_nullable") == "YES", True).when(F.col("is_nullable") == "NO", False).alias("is_nullable"),
            "ordinal_position", "comment", "embedding_text",
        )
    )


def has_schema(schemata: DataFrame) -> DataFrame:
    """PRJ-07."""
    return schemata.select(dotted_id("catalog_name").alias("source_id"), dotted_id("catalog_name", "schema_name").alias("target_id"))


def has_table(tables: DataFrame) -> DataFrame:
    return tables.select(dotted_id("table_catalog", "table_schema").alias("source_id"), dotted_id("table_catalog", "table_schema", "table_name").alias("target_id"))


def has_column(columns: DataFrame) -> DataFrame:
    return columns.select(dotted_id("table_catalog", "table_schema", "table_name").alias("source_id"), dotted_id("table_catalog", "table_schema", "table_name", "column_name").alias("target_id"))


def has_value(values: DataFrame) -> DataFrame:
    """PRJ-08: not de-duplicated."""
    return values.select(F.col("col_id").alias("source_id"), F.col("id").alias("target_id"))


def project(df: DataFrame, label: str) -> DataFrame:
    """PRJ-10: exactly the label's properties; all but ``embedding`` must be there."""
    wanted = S.NODE_PROPERTIES[label]
    missing = [c for c in wanted if c not in df.columns and c != "embedding"]
    if missing:
        raise ValueError(f"{label} lacks {', '.join(missing)}")
    return df.select(*(c for c in wanted if c in df.columns))


def references(df: DataFrame) -> DataFrame:
    """PRJ-11: REFERENCES in the contract's columns and types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in S.REFERENCES.fields))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ-12: columns or struct fields (by path) under new names, and no others."""
    return df.select(*(F.col(path).alias(name) for name, path in mapping.items()))


def columns_frame(columns: DataFrame) -> DataFrame:
    """PRJ-13: what foreign-key inference needs of each column."""
    return columns.select(
        "table_catalog", "table_schema", "table_name", "column_name", "ordinal_position",
        dotted_id("table_catalog", "table_schema", "table_name").alias("table_key"),
        dotted_id("table_catalog", "table_schema", "table_name", "column_name").alias("col_id"),
        canonical_type("data_type").alias("canon"), comment_tokens("comment").alias("tokens"),
    )
