"""Checks of a stored graph; each gives (code, n) with the number of violations (VER-01..14, GRF-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import in_catalogs, value_id
from .nodes import balanced_union


def _count(code: str, df: DataFrame, condition: Column | None = None) -> DataFrame:
    n = F.count("*") if condition is None else F.count_if(condition)
    return df.agg(n.alias("n")).select(F.lit(code).alias("code"), "n")


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """VER-04: nodes without an edge that leads to them."""
    return nodes.join(edges.select(F.col("target_id").alias("id")), "id", "left_anti")


def many_parents(edges: DataFrame) -> DataFrame:
    """VER-04: targets with two sources or more."""
    return edges.select("source_id", "target_id").distinct().groupBy("target_id").count().where("count > 1")


def verify(nodes: dict[str, DataFrame], edges: dict[str, DataFrame], version: str, sample_limit: int = 10, catalogs: list[str] | None = None) -> DataFrame:
    """OP-VERIFY: one report of all structural checks; a run is good if every n is 0.

    catalogs: only nodes of these, and edges that end in these, are looked at (FLT-06); None: the whole store.
    """
    if catalogs is not None:
        nodes = {label: df.where(in_catalogs("id", catalogs)) for label, df in nodes.items()}
        edges = {rel: df.where(in_catalogs("target_id", catalogs)) for rel, df in edges.items()}
    values, has_value, columns = nodes["Value"], edges["HAS_VALUE"], nodes["Column"]
    parents = has_value.join(columns.select(F.col("id").alias("source_id"), "data_type"), "source_id", "left")
    degree = has_value.select("source_id", "target_id").distinct()
    expected = has_value.join(values.select(F.col("id").alias("target_id"), "value"), "target_id")
    refs = edges["REFERENCES"]
    parts = [_count(f"version:{label}", df, F.col("contract_version") != version) for label, df in nodes.items()]
    parts += [
        _count("orphan:Schema", orphans(nodes["Schema"], edges["HAS_SCHEMA"])),
        _count("orphan:Table", orphans(nodes["Table"], edges["HAS_TABLE"])),
        _count("orphan:Column", orphans(columns, edges["HAS_COLUMN"])),
        _count("orphan:Value", orphans(values, has_value)),
        _count("parents:Schema", many_parents(edges["HAS_SCHEMA"])),
        _count("parents:Value", many_parents(has_value)),
        _count("type:Value", parents, ~F.coalesce(F.col("data_type").isin("STRING", "BOOLEAN"), F.lit(False))),
        _count("limit:Value", degree.groupBy("source_id").count().where(F.col("count") > sample_limit)),
        _count("id:Value", expected, F.col("target_id") != value_id("source_id", "value")),
        _count("ends:REFERENCES", refs.join(columns.select(F.col("id").alias("source_id")), "source_id", "left_anti").unionByName(refs.join(columns.select(F.col("id").alias("target_id")), "target_id", "left_anti"))),
        _count("confidence:REFERENCES", refs, ~F.col("confidence").between(0.0, 1.0)),
    ]
    return balanced_union(parts)


def count_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """VER-02, VER-05, VER-07: (name, expected, actual) where a summary and the graph differ."""
    both = expected.select("name", F.col("n").alias("expected")).join(actual.select("name", F.col("n").alias("actual")), "name", "full")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual")))


def _violations(summary: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(code, n): of how many summary rows each condition holds; null counts for false."""
    wide = summary.agg(*(F.count_if(F.coalesce(bad, F.lit(False))).alias(code) for code, bad in checks.items()))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(code).alias("code"), F.col(f"`{code}`").alias("n")) for code in checks))).alias("v")).select("v.*")


def summary_shape(summary: DataFrame) -> DataFrame:
    """VER-01: runs (status, run_id, row_counts) that did not succeed, have no id, or counted nothing."""
    return _violations(
        summary,
        {
            "status_not_success": ~F.col("status").eqNullSafe("success"),
            "missing_run_id": F.coalesce("run_id", F.lit("")) == "",
            "missing_row_counts": F.coalesce(F.size("row_counts"), F.lit(0)) < 1,
        },
    )


def fk_accounting(summary: DataFrame) -> DataFrame:
    """VER-06: rows of (fk_declared, fk_resolved, fk_skipped) whose counts contradict each other."""
    skipped, found, total = F.col("fk_skipped"), F.col("fk_resolved"), F.col("fk_declared")
    return summary.where((skipped != total - found) | (found > total) | (skipped < 0))


def sampling_accounting(summary: DataFrame) -> DataFrame:
    """VER-08: of row_counts, more sampled columns than candidates, or sampled and skipped ones that are not all candidates; a count that is missing is 0."""
    sampled, skipped, candidates = (F.coalesce(F.element_at("row_counts", F.lit(f"{k}_columns")), F.lit(0)) for k in ("sampled", "skipped", "candidate"))
    return _violations(summary, {"sampled_exceeds_candidates": sampled > candidates, "sampled_and_skipped_are_not_candidates": sampled + skipped != candidates})


# The least counts of a run over the fixture catalog.
LEAST = {"schemas": 4, "tables": 19, "fk_declared": 16, "fk_edges": 16}


def thresholds(summary: DataFrame, least: dict[str, int] | None = None) -> DataFrame:
    """VER-14: runs with a status other than success, an error, fewer rows of a kind than they should have, or no counts of the graph."""
    few = {f"few:{k}": F.coalesce(F.element_at("row_counts", F.lit(k)), F.lit(-1)) < n for k, n in (least or LEAST).items()}
    return _violations(summary, {"status": ~F.col("status").eqNullSafe("success"), "error": F.col("error").isNotNull(), **few, "no_graph_counts": F.coalesce(F.size("graph_counts"), F.lit(0)) < 1})


def id_mismatches(catalog_ids: DataFrame, graph_ids: DataFrame) -> DataFrame:
    """VER-12: ids of sampled columns that the catalog doesn't have."""
    return graph_ids.select("id").join(catalog_ids.select("id"), "id", "left_anti")


def type_mismatches(catalog: DataFrame, graph: DataFrame) -> DataFrame:
    """VER-13: columns of complex types whose type did not come through as it was."""
    complex_ = catalog.where(F.col("data_type").rlike("^(STRUCT|ARRAY|MAP|VARIANT|INTERVAL)"))
    return complex_.select("id", F.col("data_type").alias("expected")).join(graph.select("id", "data_type"), "id", "left").where(~F.col("data_type").eqNullSafe(F.col("expected")))
