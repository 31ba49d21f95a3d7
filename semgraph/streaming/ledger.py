"""A stream of texts into the embedding ledger, batch by batch.

An extra beside the batch pipeline: each micro-batch is one run of it, so a
text that comes again unchanged is not embedded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import embed


def embed_stream(texts: DataFrame, label: str, folder: str, embedder: embed.Embedder, dimension: int, model: str) -> StreamingQuery:
    """Starts a query over (id, embedding_text) that takes all there is and stops."""

    def batch(df: DataFrame, _: int) -> None:
        embed.embedded_batch(df.dropDuplicates(["id"]), label, folder, embedder, dimension, model)

    return texts.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/progress/{label.lower()}").trigger(availableNow=True).start()
