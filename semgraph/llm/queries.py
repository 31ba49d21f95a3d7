"""The subpackage's queries over the tables of a directory, and the SQL that some of them equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hmm, langid, toxicity
from .ann import nearest
from .bpe import bpe_round_trip
from .htmlcrf import extract
from .knn import top_k
from .linededup import line_dedup
from .neardup import near_dups
from .packing import pack
from .quality import QualityRules, quality
from .spelling import Spelling, spelling_groups
from .tables import table
from .whiten import whiten


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = [F.col("dup_ngram_chars")[i].alias(f"dup_chars_{n}") for i, n in enumerate(QualityRules().ngram_chars)]
    return quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_chars", *spans)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs)


def op5_line_dedup_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With passages of one and two lines and short texts, which the SQL of op5_line_dedup leaves out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, passages=True)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.expr("cast(length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity.held_out(5, 1))


def op8_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.held_out(4, 2)
    dictionaries = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), dictionaries).drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs.withColumn("held_out", toxicity.held_out(5, 0)), model).drop("text")


def op11_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), Spelling(spoil=97))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def _op1_sql(rules: QualityRules) -> str:
    sizes = [3, *rules.ngram_chars]
    gram = lambda n: " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER doc" for k in range(1, n))])
    grams = ", ".join(f"{gram(n)} AS g{n}" for n in sizes)
    begins = ", ".join(f"CASE WHEN g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 THEN 1 ELSE 0 END AS b{n}" for n in sizes)
    covers = ", ".join(f"max(b{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in sizes)
    spans = ", ".join(f"sum(c{n} * chars)::BIGINT AS d{n}" for n in rules.ngram_chars)
    verdict = " AND ".join(f"coalesce(d{n}, 0) <= {share}::DOUBLE * greatest(word_chars, 1)" for n, share in rules.ngram_chars.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
r AS (SELECT doc_id, line, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
dl AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines, sum((n - 1) * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')))::BIGINT AS dup_line_chars FROM r GROUP BY doc_id),
ws AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
w AS (SELECT doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM ws)),
g AS (SELECT doc_id, i, length(word) AS chars, {grams} FROM w WINDOW doc AS (PARTITION BY doc_id ORDER BY i)),
b AS (SELECT doc_id, i, chars, {begins} FROM g),
c AS (SELECT doc_id, chars, {covers} FROM b),
s AS (SELECT doc_id, count(*) AS n_words, sum(chars)::BIGINT AS word_chars, sum(c3)::BIGINT AS n_repeat_words, {spans} FROM c GROUP BY doc_id),
m AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars, {", ".join(f"coalesce(d{n}, 0) AS d{n}" for n in rules.ngram_chars)}
  FROM d LEFT JOIN s ON d.doc_id = s.doc_id LEFT JOIN dl ON d.doc_id = dl.doc_id
),
f AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND dup_line_chars <= {rules.line_chars}::DOUBLE * greatest(word_chars, 1) AND n_symbols <= {rules.symbols_per_word}::DOUBLE * n_words AND {verdict} AS kept,
  dup_line_chars, {", ".join(f"d{n} AS dup_chars_{n}" for n in rules.ngram_chars)}
FROM f
"""


OP4_SQL = r"""
WITH RECURSIVE ws AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM ws WHERE len(ws) >= 5)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') AS s FROM ws WHERE len(ws) BETWEEN 1 AND 4
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT p.a, p.b FROM both_have p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b AS a, a AS b FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, w.b AS other FROM reach r JOIN ways w ON w.a = r.other),
m AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, m.doc_id = m.component_id AS kept FROM m LEFT JOIN n ON n.doc_id = m.doc_id
"""


OP5_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (
  SELECT doc_id, i - 1 AS pos, lines[i] AS a, lines[i + 1] AS b, lines[i + 2] AS c
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM d)
),
w2 AS (SELECT *, regexp_matches(concat(a, b, c), '[^\x20\x09-\x0D]') AS solid FROM w),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY
        CASE WHEN regexp_matches(a, '[^\x20\x09-\x0D]') THEN a END, CASE WHEN regexp_matches(b, '[^\x20\x09-\x0D]') THEN b END,
        CASE WHEN regexp_matches(c, '[^\x20\x09-\x0D]') THEN c END ORDER BY doc_id, pos) AS k FROM w2 WHERE solid),
cov AS (SELECT DISTINCT doc_id, pos + o AS pos FROM r, (VALUES (0), (1), (2)) t(o) WHERE k > 1),
l AS (SELECT doc_id, i - 1 AS pos, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
x AS (
  SELECT l.doc_id, count(*) AS n_lines, count(cov.pos) AS n_removed,
         coalesce(string_agg(CASE WHEN cov.pos IS NULL THEN line END, chr(10) ORDER BY l.pos), '') AS text
  FROM l LEFT JOIN cov ON l.doc_id = cov.doc_id AND l.pos = cov.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE x.text END AS text,
       coalesce(x.n_lines, 0) AS n_lines, coalesce(x.n_removed, 0) AS n_removed
FROM d LEFT JOIN x ON d.doc_id = x.doc_id
"""


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality": _op1_sql(QualityRules()), "op4_near_dups": OP4_SQL, "op5_line_dedup": OP5_SQL, "op8_knn": OP8_SQL}
