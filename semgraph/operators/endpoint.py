"""An embedding endpoint called from the executors (OP-EMB, VEC-03): batches, retries, dead letters."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the most texts that one request may hold.
MOST_TEXTS = 100
DEAD = "id string, embedding_text_hash string, embedding_model string, embedding_error string, failed_at timestamp"


class Refused(Exception):
    """An answer that the same request would get again: it is not sent a second time."""


@dataclass(frozen=True)
class Endpoint:
    """How texts are sent.

    send: from at most ``size`` texts to {"index", "embedding"} of each, in any
    order; it is pickled to the executors and must bring what it needs with it.
    most_chars: a request is also closed before it would hold more characters;
    a single text beyond that is a request of its own, whole.
    attempts: times that a request is sent before its texts fail; between them
    wait, 2 wait, 4 wait ... seconds (``longest`` at most), each shortened at
    random by up to a half, so that tasks that failed together don't come back
    together.
    """

    send: Callable[[list[str]], list[dict]]
    size: int = MOST_TEXTS
    most_chars: int = 1_000_000
    attempts: int = 4
    wait: float = 0.5
    longest: float = 30.0

    def __post_init__(self) -> None:
        if self.size < 1 or self.attempts < 1 or self.most_chars < 1:
            raise ValueError("size, most_chars and attempts are at least 1")

    def ask(self, texts: list[str]) -> list[list[float]]:
        """The vectors of one request's texts in their order, all or none: anything else is an error."""
        for turn in range(self.attempts):
            try:
                return self._ordered(texts, self.send(texts))
            except Refused:
                raise
            except Exception:
                if turn + 1 == self.attempts:
                    raise
                time.sleep(min(self.longest, self.wait * 2**turn) * random.uniform(0.5, 1))
        raise AssertionError("unreachable")

    @staticmethod
    def _ordered(texts: list[str], answer: list[dict]) -> list[list[float]]:
        found = {int(r["index"]): [float(x) for x in r["embedding"]] for r in answer}
        if len(answer) != len(texts) or sorted(found) != list(range(len(texts))):
            raise ValueError(f"{len(answer)} vectors for {len(texts)} texts")
        if len({len(v) for v in found.values()}) > 1:
            raise ValueError("vectors of several sizes")
        return [found[i] for i in range(len(texts))]

    def requests(self, texts: list[str]) -> Iterator[list[str]]:
        """The texts cut into requests, in order."""
        some: list[str] = []
        chars = 0
        for text in texts:
            if some and (len(some) == self.size or chars + len(text) > self.most_chars):
                yield some
                some, chars = [], 0
            some.append(text)
            chars += len(text)
        if some:
            yield some


def endpoint_embedding(endpoint: Endpoint) -> Callable[[Column], Column]:
    """An embedder (a column from texts to result and errorMessage) that calls an endpoint.

    Arrow batches are cut into requests; a text that occurs several times in a
    batch is sent once.  The texts of a request get all their vectors or all the
    same error; a null text is an error of its own and is not sent, an empty one
    is sent.  A task that runs again sends its texts again.  The column counts as
    nondeterministic, so that no plan computes it twice.
    """

    @F.pandas_udf("result array<double>, errorMessage string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            given = [None if t is None else str(t) for t in batch]
            found: dict[str, tuple[list[float] | None, str | None]] = {}
            for texts in endpoint.requests(list(dict.fromkeys(t for t in given if t is not None))):
                try:
                    found |= {t: (v, None) for t, v in zip(texts, endpoint.ask(texts), strict=True)}
                except Exception as e:
                    found |= dict.fromkeys(texts, (None, f"{type(e).__name__}: {e}"))
            rows = [(None, "no text") if t is None else found[t] for t in given]
            yield pd.DataFrame({"result": pd.Series([r[0] for r in rows], dtype=object), "errorMessage": pd.Series([r[1] for r in rows], dtype=object)})

    return call.asNondeterministic()


def write_dead(frozen: DataFrame, folder: str, label: str) -> None:
    """Adds a run's failed rows (id, hash of the text, model, error, time) to the label's dead letters; texts are not kept there."""
    dead = frozen.where("embedding_error is not null").select("id", "embedding_text_hash", "embedding_model", "embedding_error", F.col("embedded_at").alias("failed_at"))
    dead.write.mode("append").parquet(f"{folder}/dead/{label.lower()}")


def dead_letters(spark: SparkSession, folder: str, label: str, ledger: DataFrame | None = None) -> DataFrame:
    """(id, embedding_text_hash, embedding_model, failures, embedding_error, failed_at): texts that failed, with how often and the last error; those that the ledger has by now are left out."""
    keys = ["id", "embedding_text_hash", "embedding_model"]
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/dead/{label.lower()}")
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    rows = spark.read.schema(DEAD).parquet(path.toString()) if there else spark.createDataFrame([], DEAD)
    if ledger is not None:
        same = [rows[k].eqNullSafe(ledger[k]) for k in keys]
        rows = rows.join(ledger, same[0] & same[1] & same[2], "left_anti")
    return rows.groupBy(*keys).agg(F.count("*").alias("failures"), F.max_by("embedding_error", F.struct("failed_at", "embedding_error")).alias("embedding_error"), F.max("failed_at").alias("failed_at"))
