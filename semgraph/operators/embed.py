"""Embedding with a ledger of what is already embedded (OP-EMB, SRC-10, SNK-03, SNK-04, VEC-03, VEC-04, EXT-01)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .endpoint import write_dead

Embedder = Callable[[Column], Column]


def hash_embedding(dimension: int = 64) -> Embedder:
    """EXT-01: a deterministic embedder in native expressions.

    Each word counts in one of ``dimension`` places given by its md5; the vector
    has length 1.  The struct is what a serving endpoint gives: result and
    errorMessage.
    """

    def embed(text: Column) -> Column:
        words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
        places = F.transform(words, lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), F.lit(dimension)).cast("int"))
        counts = F.transform(F.sequence(F.lit(0), F.lit(dimension - 1)), lambda i: F.size(F.filter(places, lambda p: p == i)).cast("double"))
        norm = F.greatest(F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-12))
        return F.struct(F.transform(counts, lambda x: x / norm).alias("result"), F.lit(None).cast("string").alias("errorMessage"))

    return embed


def validated(raw: Column | str, dimension: int) -> tuple[Column, Column]:
    """VEC-04: the vector (null where wrong) and the error: the endpoint's own first, then a missing vector or a wrong size."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    vector, message = raw.getField("result").cast("array<double>"), raw.getField("errorMessage")
    size = F.size(vector)
    error = F.when(message.isNotNull(), message).when(vector.isNull(), F.lit("no vector")).when(size != dimension, F.concat(F.lit("dimension "), size.cast("string"), F.lit(f" instead of {dimension}")))
    return F.when(error.isNull(), vector), error


def hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("embedding_text_hash", F.sha2("embedding_text", 256))


def embed(df: DataFrame, embedder: Embedder, dimension: int, model: str, at=None) -> DataFrame:
    """``df`` (with embedding_text and its hash) with embedding, embedding_error, embedding_model and embedded_at."""
    with_raw = df.withColumn("_raw", embedder(F.col("embedding_text")))
    vector, error = validated("_raw", dimension)
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return with_raw.withColumns({"embedding": vector, "embedding_error": error, "embedding_model": F.lit(model), "embedded_at": stamp}).drop("_raw")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """SRC-10: the ledger's snapshot, or None where there is none yet."""
    try:
        return spark.read.schema(S.LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def split_by_ledger(df: DataFrame, ledger: DataFrame | None, model: str) -> tuple[DataFrame, DataFrame]:
    """JOIN-10: rows whose text and model the ledger has (with its vector), and all others.

    A null hash is a miss, so that no row is lost between the two.
    """
    if ledger is None:
        return df.limit(0).withColumns({"embedding": F.lit(None).cast("array<double>"), "embedding_model": F.lit(model), "embedded_at": F.lit(None).cast("timestamp")}), df
    known = ledger.where(F.col("embedding_model") == model).select(F.col("id").alias("_id"), F.col("embedding_text_hash").alias("_hash"), "embedding", "embedding_model", "embedded_at")
    both = df.drop("embedding", "embedding_model", "embedded_at").join(known, F.col("id") == F.col("_id"), "left")
    hit = F.coalesce(F.col("_hash") == F.col("embedding_text_hash"), F.lit(False))
    return both.where(hit).drop("_id", "_hash"), both.where(~hit).drop("_id", "_hash", "embedding", "embedding_model", "embedded_at")


def upserted_ledger(staged: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """SNK-04: the ledger with the staged rows that have a vector and no error put in, by (id, embedding_model)."""
    keys = ["id", "embedding_model"]
    columns = ["id", "embedding_text_hash", "embedding", "embedding_model", "embedded_at"]
    new = staged.where("embedding_error is null and embedding is not null").select(*columns).groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct("embedded_at", "embedding_text_hash")).alias("r")).select("r.*")
    return new if ledger is None else ledger.join(new.select(*keys), keys, "left_anti").select(*columns).unionByName(new)


def failure_stats(df: DataFrame, label: str) -> DataFrame:
    """AGG-07: attempts and successes."""
    return df.agg(F.count("*").alias("attempts"), F.count("embedding").alias("successes")).select(F.lit(label).alias("label"), "attempts", "successes")


def failure_rates(stats: DataFrame) -> DataFrame:
    """AGG-08: the rate of failures of each label and of all (label ``*``); 0 without attempts."""
    rate = F.coalesce(F.try_divide((F.col("attempts") - F.col("successes")).cast("double"), F.col("attempts")), F.lit(0.0)).alias("failure_rate")
    whole = stats.agg(F.sum("attempts").alias("attempts"), F.sum("successes").alias("successes")).select(F.lit("*").alias("label"), "attempts", "successes")
    return stats.unionByName(whole).select("label", "attempts", "successes", rate)


def failures(stats: DataFrame) -> int:
    """How many embeddings failed."""
    return stats.agg(F.sum(F.col("attempts") - F.col("successes")).alias("n")).first()["n"] or 0


def gate(failed: int, most: int) -> None:
    """Raises if more than ``most`` embeddings failed (0: any number may)."""
    if most and failed > most:
        raise RuntimeError(f"{failed} embeddings failed; {most} may")


def current_ledger(spark: SparkSession, folder: str, label: str) -> tuple[DataFrame | None, int]:
    """The last snapshot of a label's ledger and its turn; None and 0 where there is none yet."""
    root = f"{folder}/ledger/{label.lower()}"
    if not read_pointer(spark, root):
        return None, 0
    last = spark.read.parquet(f"{root}/current").agg(F.max_by("snapshot", "turn").alias("name"), F.max("turn").alias("turn")).first()
    return read_ledger(spark, f"{root}/{last['name']}"), last["turn"]


def embedded_batch(df: DataFrame, label: str, folder: str, embedder: Embedder, dimension: int, model: str, most_failures: int = 0) -> tuple[DataFrame, DataFrame]:
    """OP-EMB: embeds what the ledger in ``folder`` lacks, freezes the result, and writes the ledger's next snapshot.

    Gives the frozen rows and the statistics.  Failed rows also go to the label's
    dead letters, before too many of them raise.  Vectors are computed once: all
    later reads are of the frozen files below ``folder``/staged (SNK-03), which
    the caller deletes when it has written them.
    """
    spark = df.sparkSession
    root = f"{folder}/ledger/{label.lower()}"
    ledger, turn = current_ledger(spark, folder, label)
    hits, misses = split_by_ledger(hashed(df), ledger, model)
    fresh = embed(misses, embedder, dimension, model)
    staged = hits.withColumn("embedding_error", F.lit(None).cast("string")).unionByName(fresh)
    path = f"{folder}/staged/{label.lower()}-{uuid.uuid4().hex}"
    staged.write.parquet(path)
    frozen = spark.read.parquet(path)
    stats = failure_stats(frozen, label)
    failed = failures(stats)
    if failed:
        write_dead(frozen, folder, label)
    gate(failed, most_failures)
    name = uuid.uuid4().hex
    upserted_ledger(frozen, ledger).write.parquet(f"{root}/{name}")
    spark.createDataFrame([(name, turn + 1)], "snapshot string, turn long").write.mode("append").parquet(f"{root}/current")
    return frozen, stats


def read_pointer(spark: SparkSession, root: str) -> bool:
    """Whether a ledger has a snapshot."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/current")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
