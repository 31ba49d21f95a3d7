"""Full-text search by an inverted index in blocks with their highest contributions (FTX-01).

A document's score for a question is the sum of its postings' contributions over
the question's words.  Postings lie in blocks of documents of like length, and
of each term and block the highest contribution is known.  A search

1. scores some documents of the question's rarest words in full; the k-th best
   score of real documents is a threshold that the k-th best of all can't be below;
2. adds up, for each block, the highest contributions of the question's words,
   and leaves out blocks whose sum stays below the threshold;
3. scores the documents of a block for all questions that visit it, in one
   product of its postings with the questions' words, and gives out only scores
   that reach the threshold, at most the best of a block (with ties).

No step leaves out a document that may be among the k best, and what is shuffled
for ranking grows with the questions and blocks, not with pairs of questions and
documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import staged

#: Documents of a block, about.
BLOCK = 1024
#: BM25's parameters: how soon more of a word counts no more, and how much length counts.
K1, B = 1.2, 0.75
#: Questions that one pass over the blocks takes; their words are told to all tasks.
AT_ONCE = 2000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, repeated ones too."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")


@dataclass(frozen=True)
class TextIndex:
    """postings (term, block, id, part): what a word of a field adds to a document's score; highs (term, block, high); terms (term, w, df, high)."""

    postings: DataFrame
    highs: DataFrame
    terms: DataFrame

    def write(self, folder: str) -> None:
        """Stores the index, postings sorted by block, so files hold ranges of blocks."""
        self.postings.repartitionByRange("block").sortWithinPartitions("block", "term").write.parquet(f"{folder}/postings")
        self.highs.write.parquet(f"{folder}/highs")
        self.terms.write.parquet(f"{folder}/terms")

    @staticmethod
    def read(spark: SparkSession, folder: str) -> TextIndex:
        return TextIndex(*(spark.read.parquet(f"{folder}/{name}") for name in ("postings", "highs", "terms")))


def build(documents: DataFrame, bm25: bool = True, weights: dict[str, float] | None = None, only: DataFrame | None = None) -> TextIndex:
    """The index of (id, field, text); without a field column all texts are one field.

    bm25: ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean length)),
    with N, df and the mean over the field's texts (null ones count as empty);
    else tf * ln((N + 1) / (df + 0.5)).  weights: factors of fields, above 0, 1
    where none is given.  only: (w), the words to be indexed.  An id has one text a field.
    """
    if "field" not in documents.columns:
        documents = documents.withColumn("field", F.lit("text"))
    texts = documents.select("field", "id", words(F.col("text")).alias("ws")).withColumn("length", F.size("ws"))
    lengths = staged(texts.select("field", "id", "length"), "lengths")
    about = lengths.groupBy("field").agg(F.count("*").alias("texts"), F.avg("length").alias("mean"))
    # Fields of a document are in one block by the id alone, so lengths order blocks where there is one field.
    size = F.floor(F.log2(F.col("length") + 1)).cast("int")
    one = about.count() == 1
    classes = lengths.groupBy(size.alias("size")).agg(F.ceil(F.count("*") / BLOCK).alias("n")) if one else None
    spots = texts.select("field", "id", "length", F.explode("ws").alias("w"))
    if only is not None:
        spots = spots.join(only.select("w").distinct(), "w", "left_semi")
    counts = spots.groupBy("field", "w", "id", "length").agg(F.count("*").alias("tf"))
    spread = lambda n: F.pmod(F.xxhash64("id"), n).cast("long")
    if one:  # at most 32 classes
        counts = counts.withColumn("size", size).join(F.broadcast(classes), "size").withColumn("block", F.col("size") * F.lit(2**40) + spread(F.col("n"))).drop("size", "n")
    else:
        counts = counts.withColumn("block", spread(F.lit(max(1, -(-lengths.select("id").distinct().count() // BLOCK)))))
    counts = staged(counts.withColumn("term", F.concat_ws(" ", "field", "w")), "counts")
    df = counts.groupBy("field", "w", "term").agg(F.count("*").alias("df")).join(about, "field")
    if bm25:
        rarity = F.log(1 + (F.col("texts") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        often = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    else:
        rarity, often = F.log((F.col("texts") + 1) / (F.col("df") + F.lit(0.5))), F.col("tf")
    factor = F.lit(1.0)
    for field, weight in (weights or {}).items():
        factor = F.when(F.col("field") == field, F.lit(float(weight))).otherwise(factor)
    known = df.select("term", "mean", "df", F.col("w").alias("word"), (rarity * factor).alias("rarity"))
    postings = staged(counts.join(known.drop("word"), "term").select("term", "block", "id", (often * F.col("rarity")).alias("part"), "df"), "postings")
    highs = staged(postings.groupBy("term", "block").agg(F.max("part").alias("high")), "highs")
    terms = staged(highs.groupBy("term").agg(F.max("high").alias("high")).join(known.select("term", F.col("word").alias("w"), "df"), "term"), "terms")
    return TextIndex(postings.drop("df"), highs, terms)


@dataclass(frozen=True)
class Search:
    """The frames of a search: asked (question_id, term, df, high), seeds that were read for the threshold, thresholds, visits (question_id, block), and found (question_id, id, score)."""

    asked: DataFrame
    seeds: DataFrame
    thresholds: DataFrame
    visits: DataFrame
    found: DataFrame

    def top(self, k: int, digits: int) -> DataFrame:
        best = Window.partitionBy("question_id").orderBy(F.desc("score"), "id")
        return self.found.withColumn("score", F.round("score", digits)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _scored(index: TextIndex, asked: DataFrame, visits: DataFrame, k: int, slack: float) -> DataFrame:
    """(question_id, id, score) of the best documents of the visited blocks; asked: (question_id, term, least) of AT_ONCE questions at most."""
    rows = asked.toArrow()
    questions, of = np.unique(rows.column("question_id").to_numpy(zero_copy_only=False), return_inverse=True)
    least = np.zeros(len(questions))
    least[of] = rows.column("least").to_numpy()
    terms, term_of = np.unique(rows.column("term").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    order = np.argsort(term_of, kind="stable")
    begins, of = np.searchsorted(term_of[order], np.arange(len(terms) + 1)), of[order]
    known = pa.array(terms.tolist(), type=pa.string())
    kind, id_kind = asked.schema["question_id"].dataType, index.postings.schema["id"].dataType
    names = pa.array(questions.tolist())
    schema = T.StructType([T.StructField("question_id", kind), T.StructField("id", id_kind), T.StructField("score", T.DoubleType())])

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: postings of a block, right: the questions that visit it."""
        term = pc.index_in(left.column("term"), value_set=known).combine_chunks()
        own = left.column("id").combine_chunks().dictionary_encode()
        wanted = np.zeros(len(questions), dtype=bool)
        wanted[pc.index_in(right.column("question_id"), value_set=names.cast(right.schema.field("question_id").type)).to_numpy(zero_copy_only=False)] = True
        at = np.flatnonzero(np.asarray(term.is_valid()))
        term, doc, part = term.to_numpy(zero_copy_only=False)[at].astype(np.int64), own.indices.to_numpy(zero_copy_only=False)[at], left.column("part").to_numpy()[at]
        score = np.zeros(len(own.dictionary) * len(questions))
        for lo in range(0, len(at), 1 << 16):
            t = term[lo : lo + (1 << 16)]
            many = begins[t + 1] - begins[t]
            more = np.repeat(np.arange(len(t)), many)
            asks = of[np.repeat(begins[t], many) + np.arange(len(more)) - np.repeat(np.cumsum(many) - many, many)]
            score += np.bincount(doc[lo : lo + (1 << 16)][more].astype(np.int64) * len(questions) + asks, weights=part[lo : lo + (1 << 16)][more], minlength=len(score))
        score = score.reshape(-1, len(questions))
        reach = least.copy()
        if len(score) > k:
            reach = np.maximum(reach, np.partition(score, len(score) - k, axis=0)[len(score) - k] - slack)
        d, q = np.nonzero((score >= reach) & (score > 0) & wanted)
        return pa.table([names.take(pa.array(q)).cast(right.schema.field("question_id").type), own.dictionary.take(pa.array(d)), pa.array(score[d, q])], names=["question_id", "id", "score"])

    postings = index.postings.join(asked.select("term").distinct(), "term", "left_semi").join(visits.select("block").distinct(), "block", "left_semi")
    return postings.groupBy("block").cogroup(visits.groupBy("block")).applyInArrow(solve, schema)


def search(index: TextIndex, queries: DataFrame, k: int, digits: int = 4, seeds: int = 20) -> Search:
    """The steps of a search of (question_id, text); see the module.  seeds: about how many postings of rare words are read first, for each of k."""
    by_question = Window.partitionBy("question_id")
    asked = queries.where("question_id is not null").select("question_id", F.explode(F.array_distinct(words(F.col("text")))).alias("w")).distinct()
    asked = staged(asked.join(index.terms, "w").select("question_id", "term", "df", "high"), "asked")
    wanted = seeds * k
    # Rare words first; of a longer list a share by hash will do, as any k documents give a threshold.
    before = F.coalesce(F.sum("df").over(by_question.orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rare = asked.withColumn("_before", before).where(F.col("_before") < wanted).withColumn("_share", F.lit(1000.0 * 2 * wanted) / F.col("df"))
    first = rare.select("question_id", "term", "_share").join(index.postings, "term").where(F.pmod(F.xxhash64("id"), F.lit(1000)) < F.col("_share")).select("question_id", "id", "part")
    best = Window.partitionBy("question_id").orderBy(F.desc("some"), "id")
    some = first.groupBy("question_id", "id").agg(F.sum("part").alias("some")).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= 2 * k).select("question_id", "id")
    full = some.join(asked.select("question_id", "term"), "question_id").join(index.postings.select("term", "id", "part"), ["term", "id"])
    scores = full.groupBy("question_id", "id").agg(F.sum("part").alias("score"))
    nth = F.row_number().over(by_question.orderBy(F.desc("score")))
    # Below by what rounding can hide, so that ties after it stay.
    slack = 2 * 10.0**-digits
    thresholds = staged(scores.withColumn("_n", nth).where(F.col("_n") == k).select("question_id", (F.col("score") - slack).alias("least")), "thresholds")
    told = asked.join(thresholds, "question_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    bounds = told.select("question_id", "term", "least").join(index.highs, "term").groupBy("question_id", "block", "least").agg(F.sum("high").alias("most"))
    visits = staged(bounds.where(F.col("most") >= F.col("least")).select("question_id", "block"), "visits")
    turns = -(-told.select("question_id").distinct().count() // AT_ONCE)
    found = []
    for turn in range(turns):
        mine = lambda df, turn=turn: df.where(F.pmod(F.xxhash64("question_id"), F.lit(turns)) == turn) if turns > 1 else df
        found.append(_scored(index, mine(told.select("question_id", "term", "least")), mine(visits), k, slack))
    none = queries.select("question_id").limit(0).crossJoin(index.postings.select("id").limit(0)).withColumn("score", F.lit(0.0))
    whole = none
    for f in found:
        whole = whole.unionAll(f)
    return Search(asked, first, thresholds, visits, whole)


def topk(queries: DataFrame, documents: DataFrame, k: int, bm25: bool = False, weights: dict[str, float] | None = None, digits: int = 4) -> DataFrame:
    """(question_id, id, score, rank): the k best documents (id, text or id, field, text) of each (question_id, text); ties to the smaller id.

    Only the words that are asked for are indexed.  Null ids of questions ask
    nothing, null texts have no words; a question gets no row where no document has one of its words.
    """
    only = queries.select(F.explode(F.array_distinct(words(F.col("text")))).alias("w"))
    return search(build(documents, bm25, weights, only), queries, k, digits).top(k, digits)
