"""From a catalog snapshot to a verified graph (OP-EXTRACT, OP-VALUES, OP-EMB, OP-FK, OP-LOAD, OP-STALE, OP-VERIFY, OP-PREFLIGHT)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import IngestSettings
from ..functions.ids import value_id
from ..operators import embed, fk, nodes, store, values, verify
from ..sources import metadata

Reader = Callable[[str, str, str], DataFrame]


@dataclass(frozen=True)
class Graph:
    """Node frames by label and edge frames by relation."""

    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]


def preflight(spark: SparkSession, snapshot: metadata.Snapshot, folder: str, settings: IngestSettings, embedder: embed.Embedder | None = None) -> None:
    """OP-PREFLIGHT, SNK-09: a table at least must be in scope, the folder is made if it isn't there, and the embedder gives vectors of the right size."""
    if not metadata.scoped(snapshot, list(settings.schemas) or None).tables.limit(1).count():
        raise ValueError("no table is in scope")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path):
        raise ValueError(f"{folder} can't be made")
    if settings.embed_labels and embedder is not None:
        error = spark.range(1).select(embed.validated(embedder(F.lit("probe")), settings.embedding_dimension)[1].alias("e")).first()["e"]
        if error is not None:
            raise ValueError(f"the embedder gives no vector of {settings.embedding_dimension}: {error}")


def extract(snapshot: metadata.Snapshot, settings: IngestSettings) -> Graph:
    """OP-EXTRACT: structural nodes and edges; lazy."""
    s = metadata.scoped(snapshot, list(settings.schemas) or None)
    return Graph(
        {"Database": nodes.database_nodes(s.schemata), "Schema": nodes.schema_nodes(s.schemata), "Table": nodes.table_nodes(s.tables, settings.layers), "Column": nodes.column_nodes(s.columns)},
        {"HAS_SCHEMA": nodes.has_schema(s.schemata), "HAS_TABLE": nodes.has_table(s.tables), "HAS_COLUMN": nodes.has_column(s.columns)},
    )


def sample(snapshot: metadata.Snapshot, read: Reader, settings: IngestSettings, folder: str) -> DataFrame | None:
    """OP-VALUES, OP-BATCH over every table with columns to sample; None if there are none.

    ``settings.tables_per_batch`` tables are one plan, whose values are written
    to ``folder`` before the next; what is given reads them there.
    """
    wanted = values.sampleable(metadata.scoped(snapshot, list(settings.schemas) or None).columns)
    # Names only: a row for each table.
    tables = [((r["table_catalog"], r["table_schema"], r["table_name"]), r["columns"]) for r in wanted.orderBy("table_catalog", "table_schema", "table_name").collect()]
    spark = wanted.sparkSession
    for lo in range(0, len(tables), settings.tables_per_batch):
        frames = {k: (read(*k), c) for k, c in tables[lo : lo + settings.tables_per_batch]}
        values.sample(frames, settings.sample_limit, settings.cardinality_threshold, settings.columns_per_scan, settings.exact_cardinality).write.mode("append").parquet(folder)
    return spark.read.schema(S.SAMPLED).parquet(folder) if tables else None


def ingest(spark: SparkSession, snapshot: metadata.Snapshot, read: Reader, constraints: DataFrame, folder: str, settings: IngestSettings | None = None, declared: DataFrame | None = None, embedder: embed.Embedder | None = None) -> DataFrame:
    """Builds the graph in ``folder`` and gives its verification report.

    Nodes go first, then edges whose ends are known; Values that this run did
    not write again go (unless it found none at all, which would rather be a
    failure to read).
    """
    settings = settings or IngestSettings()
    preflight(spark, snapshot, folder, settings, embedder)
    graph, target = extract(snapshot, settings), store.GraphStore(spark, folder)
    started = spark.range(1).select(F.current_timestamp().cast("string").alias("t")).first()["t"]
    transient = f"{folder}/sampled-{uuid.uuid4().hex}"
    found = sample(snapshot, read, settings, transient)
    labels = dict(graph.nodes)
    if found is not None:
        found = found.withColumn("id", value_id("col_id", "val"))
        labels["Value"] = values.value_nodes(found, started).withColumn("embedding_text", F.col("value"))
    stats = []
    for label, df in labels.items():
        if label in settings.embed_labels:
            df, counted = embed.embedded_batch(df, label, folder, embedder or embed.hash_embedding(settings.embedding_dimension), settings.embedding_dimension, settings.embedding_model, settings.embedding_failure_max)
            stats.append(counted)
        target.write_nodes(label, nodes.project(df, label))
    if found is not None and target.read("Value").where(F.col("last_run") == started).limit(1).count():
        target.delete("Value", store.stale(started, list(settings.catalogs), target.read("Value").schema["last_run"].dataType, list(settings.schemas)))
    if found is not None:
        target.write_edges("HAS_VALUE", nodes.has_value(found), "Column", "Value")
    for rel, (a, b) in {"HAS_SCHEMA": ("Database", "Schema"), "HAS_TABLE": ("Schema", "Table"), "HAS_COLUMN": ("Table", "Column")}.items():
        target.write_edges(rel, graph.edges[rel], a, b)
    scope = metadata.scoped(snapshot, list(settings.schemas) or None)
    target.write_edges("REFERENCES", fk.discover(scope.columns, constraints, declared, settings.fk_threshold, settings.fk_max_columns), "Column", "Column")
    store.delete(spark, transient)
    store.delete(spark, f"{folder}/staged")
    empty_values = spark.createDataFrame([], "id string, value string, contract_version string")
    stored = {label: target.read(label) for label in labels} | ({} if found is not None else {"Value": empty_values})
    edges = {rel: target.read(rel) for rel in S.REL_TYPES if found is not None or rel != "HAS_VALUE"} | ({} if found is not None else {"HAS_VALUE": spark.createDataFrame([], "source_id string, target_id string")})
    return verify.verify(stored, edges, S.CONTRACT_VERSION, settings.sample_limit, list(settings.catalogs) if settings.scoped_verification else None)


def summary(spark: SparkSession, run_id: str, job: str, report: DataFrame, counts: DataFrame, status: str = "success") -> DataFrame:
    """SNK-05, SNK-07: one row of a run's counts and violations."""
    violations = report.where("n > 0").agg(F.array_sort(F.collect_list("code")).alias("violations"))
    rows = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("row_counts"))
    return rows.crossJoin(violations).select(F.lit(run_id).alias("run_id"), F.lit(job).alias("job_name"), F.lit(S.CONTRACT_VERSION).alias("contract_version"), F.current_timestamp().alias("started_at"), F.lit(status).alias("status"), "row_counts", "violations", (F.size("violations") == 0).alias("verify_ok"))


def summary_json(df: DataFrame) -> str:
    """SNK-06: the row as JSON."""
    return json.dumps(json.loads(df.select(F.to_json(F.struct("*")).alias("j")).first()["j"]), sort_keys=True)
