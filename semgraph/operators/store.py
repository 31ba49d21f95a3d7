"""The property graph as parquet, one folder a label or relation (SNK-01, SNK-02, SNK-05, SNK-06, SNK-10, AGG-11)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .clustered import Clustered, Report
from .nodes import balanced_union


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-01: the old rows whose key is not among the new ones, and the new ones, one a key."""
    new = new.dropDuplicates(keys)
    return new if old is None else old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def matched_edges(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """SNK-02, JOIN-12: edges whose both ends are nodes, one for each pair."""
    known = edges.join(sources.select(F.col("id").alias("source_id")), "source_id", "left_semi").join(targets.select(F.col("id").alias("target_id")), "target_id", "left_semi")
    return known.dropDuplicates(["source_id", "target_id"])


def stale(started_at, catalogs: list[str], kind, schemas: list[str] | None = None) -> Column:
    """Whether a Value is of the run's catalogs and schemas and was last written by an earlier run; kind: the type of last_run."""
    mine = F.col("catalog").isin(catalogs)
    if schemas:
        mine &= F.col("schema").isin(schemas)
    return F.coalesce(mine & (F.col("last_run") < F.lit(started_at).cast(kind)), F.lit(False))


def without_stale(values: DataFrame, started_at, catalogs: list[str], schemas: list[str] | None = None) -> DataFrame:
    """SNK-10, OP-STALE: Values but those of the run's catalogs and schemas that an earlier run wrote last."""
    return values.where(~stale(started_at, catalogs, values.schema["last_run"].dataType, schemas))


def duplicate_ids(nodes: DataFrame) -> DataFrame:
    """SNK-11: (id, n) of ids that several nodes of a label bear, or none at all (null)."""
    return nodes.groupBy("id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("id").isNull())


def delete(spark: SparkSession, path: str) -> None:
    """SNK-03: removes transient files; a path that isn't there is left at that."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def counts(frames: dict[str, DataFrame]) -> DataFrame:
    """AGG-11: (name, n) of each label or relation."""
    return balanced_union([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in frames.items()])


def batches(tables: DataFrame, size: int = 200) -> int:
    """OP-BATCH: how many batches of ``size`` tables there are."""
    return -(-tables.count() // size)


def in_batch(df: DataFrame, keys: DataFrame, columns: list[str], size: int = 200) -> DataFrame:
    """JOIN-09: the rows of a batch of tables; ``keys`` is broadcast if it holds at most ``size`` rows."""
    small = keys.limit(size + 1).count() <= size
    return df.join(F.broadcast(keys) if small else keys, columns, "left_semi")


@dataclass(frozen=True)
class GraphStore:
    """A folder of clustered tables, one a label or relation: a write makes anew only the files whose range of ids it touches, and of two writers at once one gets an error."""

    spark: SparkSession
    folder: str
    rows: int = 1_000_000

    def table(self, name: str, keys: tuple[str, ...] = ("id",)) -> Clustered:
        return Clustered(self.spark, f"{self.folder}/{name}", keys, self.rows)

    def read(self, name: str) -> DataFrame | None:
        return self.table(name).read()

    def write(self, name: str, df: DataFrame) -> Report:
        return self.table(name, ("id",) if "id" in df.columns else ("source_id", "target_id")).write(df)

    def write_nodes(self, label: str, df: DataFrame) -> Report:
        return self.table(label).upsert(df)

    def write_edges(self, rel: str, df: DataFrame, source: str, target: str) -> Report:
        return self.table(rel, ("source_id", "target_id")).upsert(matched_edges(df, self.read(source), self.read(target)))

    def delete(self, name: str, where: Column) -> Report:
        """SNK-10: rows for which ``where`` holds go."""
        return self.table(name).delete(where)


def append_summary(summary: DataFrame, path: str) -> None:
    """SNK-05: one row more; readers merge schemas."""
    summary.write.mode("append").parquet(path)


def latest_summary(spark: SparkSession, path: str, job: str, run_id: str | None = None) -> DataFrame:
    """SRC-14, SRT-07: the run by its id (an error if several have it), or the job's newest success."""
    rows = spark.read.option("mergeSchema", "true").parquet(path).where(F.col("job_name") == job)
    if run_id is not None:
        found = rows.where(F.col("run_id") == run_id)
        if found.limit(2).count() > 1:
            raise ValueError(f"several summaries of run {run_id}")
        return found
    return rows.where("status = 'success'").orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)
