"""Tables from blueprints (OP-MATERIALIZE)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sanitize_identifier
from ..operators import blueprint, store


def materialize(spark: SparkSession, tables: DataFrame, folder: str, at_once: int = 8) -> DataFrame:
    """Writes each table of a blueprint as parquet below ``folder`` and gives (schema, table, n_rows, n_columns, fallbacks, error).

    A table that can't be written is reported and doesn't stop the others.  The
    sample rows of all tables are dealt to a folder each in one pass, so a table
    reads its own only, and counted by table in one more; ``at_once`` tables are
    written at the same time.  Keys that hold (as planned_primary_keys and
    planned_foreign_keys tell, of tables that were written) are the engine's own
    table ``_keys`` beside them.  A blueprint's tables and sample rows are few;
    its names and types are what the driver sees.
    """
    planned, staged = blueprint.planned_columns(tables).persist(), f"{folder}/_staged-{uuid.uuid4().hex}"
    try:
        shape = planned.groupBy("schema", "table").agg(F.array_sort(F.collect_list(F.struct("place", "column", "lake_type", "fallback"))).alias("cs"))
        rows = tables.select(F.col("schema").alias("s"), sanitize_identifier("table", "t").alias("t"), F.explode("rows").alias("r")).where("s <> '' and t <> ''")
        rows.repartition("s", "t").write.partitionBy("s", "t").parquet(staged)
        n_rows = {(r["s"], r["t"]): r["count"] for r in spark.read.parquet(staged).groupBy("s", "t").count().collect()} if rows.limit(1).count() else {}

        def made(r: Row) -> tuple:
            n = n_rows.get((r["schema"], r["table"]), 0)
            own = spark.read.schema("r array<string>").parquet(f"{staged}/s={r['schema']}/t={r['table']}") if n else spark.createDataFrame([], "r array<string>")
            cells = [F.get("r", F.lit(c["place"])).try_cast("string" if c["lake_type"] == "STRING" else c["lake_type"].lower()).alias(c["column"]) for c in r["cs"]]
            error = None
            try:
                own.select(*cells).write.mode("overwrite").parquet(f"{folder}/{r['schema']}/{r['table']}")
            except PySparkException as e:
                error = str(e).splitlines()[0]
            return r["schema"], r["table"], 0 if error else n, len(r["cs"]), sum(c["fallback"] for c in r["cs"]), error

        with ThreadPoolExecutor(at_once) as pool:
            done = list(pool.map(made, shape.orderBy("schema", "table").collect()))
        result = spark.createDataFrame(done, "schema string, table string, n_rows long, n_columns int, fallbacks int, error string")
        keys(tables, planned, result).write.mode("overwrite").parquet(f"{folder}/_keys")
        return result
    finally:
        store.delete(spark, staged)
        planned.unpersist()


def keys(tables: DataFrame, planned: DataFrame, results: DataFrame) -> DataFrame:
    """(schema, table, kind, name, columns, parent, referred) of the keys between tables that were written."""
    written = results.where("error is null").select("schema", "table")
    primary = blueprint.planned_primary_keys(tables, planned).join(written, ["schema", "table"], "left_semi")
    foreign = blueprint.planned_foreign_keys(tables, planned).join(written, ["schema", "table"], "left_semi").join(written.withColumnRenamed("table", "parent"), ["schema", "parent"], "left_semi")
    none = F.lit(None)
    return primary.select("schema", "table", F.lit("PRIMARY KEY").alias("kind"), "name", F.col("key").alias("columns"), none.cast("string").alias("parent"), none.cast("array<string>").alias("referred")).unionByName(
        foreign.select("schema", "table", F.lit("FOREIGN KEY").alias("kind"), "name", "columns", "parent", "referred")
    )


def totals(results: DataFrame) -> DataFrame:
    """AGG-19: the sums of several results."""
    return results.agg(F.count_if(F.col("error").isNull()).alias("tables_created"), F.count_if(F.col("error").isNotNull()).alias("tables_skipped"), F.sum("n_rows").alias("rows_inserted"), F.sum("fallbacks").alias("type_fallbacks"))
