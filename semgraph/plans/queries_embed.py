"""Queries of the endpoint client: documents embedded through an endpoint that fails now and then."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import embed
from ..operators.endpoint import Endpoint, Refused, dead_letters, endpoint_embedding
from ..registry import query, table
from ..sources.shared import own_folder


class Flaky:
    """An endpoint for tests: answers backwards, fails once on requests whose first text's md5 starts with 1, refuses requests with a text whose md5 starts with 00."""

    def __init__(self) -> None:
        self.failed: set[str] = set()

    def __call__(self, texts: list[str]) -> list[dict]:
        keys = [hashlib.md5(t.encode()).hexdigest() for t in texts]
        if keys[0].startswith("1") and keys[0] not in self.failed:
            self.failed.add(keys[0])
            raise ConnectionError("try again")
        if any(k.startswith("00") for k in keys):
            raise Refused("a text")
        return [{"index": i, "embedding": [len(t), ord(k[2])]} for i, (t, k) in enumerate(zip(texts, keys, strict=True))][::-1]


@query("""SELECT doc_id, CASE WHEN error IS NULL THEN length(text)::DOUBLE END AS n_chars, CASE WHEN error IS NULL THEN ascii(substr(md5(text), 3, 1))::DOUBLE END AS mark, error, CASE WHEN error IS NULL THEN 0 ELSE 2 END::BIGINT AS failures, true AS once
FROM (SELECT *, CASE WHEN text IS NULL THEN 'no text' WHEN md5(text) LIKE '00%' THEN 'Refused: a text' END AS error FROM documents)""")
def embed_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-EMB: all documents in requests of 100, then what failed one by one.

    once: whether the second run asked for a document if and only if the first
    had failed on it.  failures: how often the dead letters have a document that
    the ledger lacks.
    """
    folder = own_folder(spark, "embedded")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("embedding_text"), "doc_id")
    runs = [embed.embedded_batch(docs, "Document", folder, endpoint_embedding(Endpoint(Flaky(), size=size, wait=0.0)), 2, "flaky")[0] for size in (100, 1)]
    first = runs[0].select("id", F.col("embedding_error").isNotNull().alias("failed"), F.col("embedded_at").alias("before"))
    dead = dead_letters(spark, folder, "Document", embed.current_ledger(spark, folder, "Document")[0]).select("id", "failures")
    again = F.col("embedded_at") != F.col("before")
    return runs[1].join(first, "id").join(dead, "id", "left").select("doc_id", F.col("embedding")[0].alias("n_chars"), F.col("embedding")[1].alias("mark"), F.col("embedding_error").alias("error"), F.coalesce("failures", F.lit(0)).alias("failures"), (again == F.col("failed")).alias("once"))
