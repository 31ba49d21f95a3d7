"""A training corpus from the documents table: toxicity, quality, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of documents.  In every stage other
columns of docs are left out whatever their names, a null text counts as an
empty one, texts of any length are read whole, and an empty table gives an empty
one.  Ids need not be unique: rows are documents of their own, but for those
that a stage says it takes together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semgraph.llm import toxicity
from semgraph.llm.linededup import line_dedup
from semgraph.llm.neardup import NearDup, near_dup_rows
from semgraph.llm.packing import pack
from semgraph.llm.quality import quality
from semgraph.llm.tables import drop_kept, kept, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The stage takes pairs at a similarity of 0.80 or more as near copies; the operator alone takes 0.85.
NEAR = NearDup(percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of ``sf_dir``, scores below 0.5; a null or empty text is scored as no words, and without labels all stay."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.labelled_rows(docs, labels))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, which a null or empty text does not."""
    return quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of repeated three-line windows; n_chars counts what is left.

    A text left empty goes; one that was null or empty before stays.  Of equal
    windows the one of the smallest id stays (null first, then by the text's
    hash); rows equal in id and text lose the same lines.
    """
    cleaned = line_dedup(docs.select(*COLUMNS))
    emptied = (F.col("n_removed") > 0) & (F.length("text") == 0)
    return cleaned.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, of several such the one with the smallest hash of its text.

    Of rows equal in id and text one stays, null ids included.  Texts without
    words and rows with a null id are near copies of nothing.
    """
    verdicts = near_dup_rows(docs.select("doc_id", "text"), NEAR).where("not first").select("doc_id", "text_hash").distinct()
    # One shuffle of the texts serves the join and the fold of equal rows.
    hashed = docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash"))
    return hashed.join(verdicts.hint("merge"), ["doc_id", "text_hash"], "left_anti").dropDuplicates(["doc_id", "text_hash"]).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens; a null or empty text is its end alone, each row is packed by itself."""
    packed = pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_dups),
    ("packing", pack_sequences),
]

#: Classifier, near-dedup and tokenizer have no SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again as the next one's docs."""
    docs, made = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
        drop_kept(*made)  # the stage before has been read for the last time
        made = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
