"""Queries of the clustered store, full-text search by BM25 and by field, and the stored vector index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fulltext, samples, sketches, vectorindex
from ..operators.clustered import Clustered
from ..operators.nodes import balanced_union
from ..operators.pages import Pages
from ..registry import query, table
from ..sources.shared import own_folder


def _orders(spark: SparkSession, sf_dir: str) -> tuple[Clustered, DataFrame]:
    """The orders as a clustered table of some sixty files."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    store = Clustered(spark, own_folder(spark, "orders"), ("o_orderkey",), rows=max(1, orders.count() // 60))
    store.write(orders)
    return store, orders


@query("""WITH m AS (SELECT max(o_orderkey) AS m FROM orders) SELECT o_orderkey, o_custkey, CASE WHEN 100 * o_orderkey <= m THEN 0 ELSE o_totalprice END::DOUBLE AS price, CASE WHEN 100 * o_orderkey <= m THEN 'new' END AS note FROM orders, m
UNION ALL SELECT o_orderkey + m + 1, o_custkey, 1, 'added' FROM orders, m WHERE 100 * o_orderkey <= m""")
def clustered_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01: a hundredth of the keys get new values and a new column, as many keys are added behind the last."""
    store, orders = _orders(spark, sf_dir)
    most = orders.agg(F.max("o_orderkey").alias("m")).first()["m"]
    some = orders.where(100 * F.col("o_orderkey") <= most)
    price = lambda v: F.lit(v).cast(orders.schema["o_totalprice"].dataType).alias("o_totalprice")
    changed = some.select("o_orderkey", "o_custkey", price(0), F.lit("new").alias("note"))
    store.upsert(changed.unionByName(some.select((F.col("o_orderkey") + most + 1).alias("o_orderkey"), "o_custkey", price(1), F.lit("added").alias("note"))))
    return store.read().select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("price"), "note")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 10 <> 3 AND o_orderkey BETWEEN 100 AND 5000")
def clustered_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-10: rows go by a condition; what is read after that is one range of keys."""
    store, _ = _orders(spark, sf_dir)
    store.delete(F.col("o_custkey") % 10 == 3)
    return store.read(low=100, high=5000).select("o_orderkey", "o_custkey")


def _bm25(fields: str, k: int) -> str:
    """SQL of the k best by BM25 for asked (question_id, w) over d (field, id, ws, factor), exhaustive."""
    return f"""{fields}, n AS (SELECT field, count(*) AS texts, avg(len(ws)) AS mean FROM d GROUP BY field), p0 AS (SELECT field, id, factor, len(ws) AS length, unnest(ws) AS w FROM d),
p AS (SELECT field, id, factor, length, w, count(*) AS tf FROM p0 GROUP BY ALL), f AS (SELECT field, w, count(*) AS df FROM p GROUP BY ALL),
c AS (SELECT p.w, id, factor * ln(1 + (texts - df + 0.5) / (df + 0.5)) * tf * ({fulltext.K1} + 1) / (tf + {fulltext.K1} * (1 - {fulltext.B} + {fulltext.B} * length / mean)) AS part FROM p JOIN f USING (field, w) JOIN n USING (field)),
s AS (SELECT question_id, id, round(sum(part), 4) AS score FROM asked JOIN c USING (w) GROUP BY ALL) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id)::INTEGER AS rank FROM s) WHERE rank <= {k}"""


WORDS = "list_filter(string_split_regex(lower(coalesce({0}, '')), '[^a-z0-9]+'), lambda w: w <> '')"


@query(_bm25(f"WITH asked AS (SELECT item_id AS question_id, unnest(list_distinct({WORDS.format('text')})) AS w FROM benchmark), d AS (SELECT 'text' AS field, doc_id AS id, {WORDS.format('text')} AS ws, 1.0 AS factor FROM documents)", 10))
def fulltext_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FTX-01: every benchmark passage asks all documents."""
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text")
    return fulltext.topk(asked, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), 10, bm25=True)


@query(_bm25(f"WITH q AS (SELECT DISTINCT p_type AS question_id FROM part), asked AS (SELECT question_id, unnest(list_distinct({WORDS.format('question_id')})) AS w FROM q), d AS (SELECT 'name' AS field, p_partkey AS id, {WORDS.format('p_name')} AS ws, 2.0 AS factor FROM part UNION ALL SELECT 'type', p_partkey, {WORDS.format('p_type')}, 1.0 FROM part)", 5))
def fulltext_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FTX-01 by field: types of parts ask the parts' names, which count twice, and types."""
    part = table(spark, sf_dir, "part")
    texts = part.select(F.lit("name").alias("field"), F.col("p_partkey").alias("id"), F.col("p_name").alias("text")).unionAll(part.select(F.lit("type"), "p_partkey", "p_type"))
    asked = part.select(F.col("p_type").alias("question_id")).distinct().withColumn("text", F.col("question_id"))
    return fulltext.topk(asked, texts, 5, bm25=True, weights={"name": 2.0})


def stored_topk(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The three nearest of the vectors whose id leaves 50, through an index that is stored and read again; keep: columns of the found ones."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), *keep)
    folder = own_folder(spark, "vectors")
    vectorindex.build(vectors).write(folder)
    return vectorindex.topk(vectors.where("id % 100 = 50").withColumnRenamed("id", "question_id"), vectorindex.VectorIndex.read(spark, folder), 3, keep=keep)


@query("""SELECT question_id, id, score, rank FROM (SELECT q.vec_id AS question_id, i.vec_id AS id, round(list_dot_product(q.embedding::DOUBLE[], i.embedding::DOUBLE[]) / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_dot_product(i.embedding::DOUBLE[], i.embedding::DOUBLE[]))), 6) AS score,
row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.embedding::DOUBLE[], i.embedding::DOUBLE[]) / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_dot_product(i.embedding::DOUBLE[], i.embedding::DOUBLE[]))), 6) DESC, i.vec_id)::INTEGER AS rank FROM embeddings q, embeddings i WHERE q.vec_id % 100 = 50) WHERE rank <= 3""")
def vector_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11, VEC-01: an index is stored, read again and asked."""
    return stored_topk(spark, sf_dir)


#: The tables to sample: the columns shown, of which the first ones, as many as stated, tell rows apart.
SAMPLED = {
    "region": (1, ["r_regionkey", "r_name"]), "nation": (1, ["n_nationkey", "n_name", "n_regionkey"]), "customer": (1, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]), "supplier": (1, ["s_suppkey", "s_name", "s_nationkey"]),
    "part": (1, ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]), "orders": (1, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]), "lineitem": (2, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]), "events": (1, ["event_id", "user_id", "event_type"]),
    "documents": (1, ["doc_id", "lang", "source", "n_chars"]), "labels": (1, ["doc_id", "quality", "toxic"]), "pages": (1, ["page_id", "url"]), "benchmark": (1, ["item_id"]), "embeddings": (1, ["vec_id", "label"]), "conversations": (2, ["conv_id", "turn", "role"]),
}


def _sample_sql(name: str, keys: int, columns: list[str], k: int = 5) -> str:
    texts = ", ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns[:keys])
    row = "{" + ", ".join(f"'{c}': {c}" for c in columns) + "}"
    return f"(SELECT '{name}' AS \"table\", (row_number() OVER (ORDER BY hash, \"row\"))::INTEGER AS place, hash, \"row\" FROM (SELECT md5(concat_ws('|', '0', {texts})) AS hash, to_json({row})::VARCHAR AS \"row\" FROM {name}) ORDER BY hash, \"row\" LIMIT {k})"


@query(" UNION ALL ".join(_sample_sql(n, k, cs) for n, (k, cs) in SAMPLED.items()))
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-QGEN-DENSE, SRT-08: five rows of every table, those of the smallest hashes."""
    tables = {n: table(spark, sf_dir, n).select(*cs) for n, (_, cs) in SAMPLED.items()}
    return samples.sample_rows(tables, 5, {n: cs[:k] for n, (k, cs) in SAMPLED.items()})


@query("""WITH p AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount) - 1 AS place FROM lineitem), n AS (SELECT count(*) // 7 + 1 AS size FROM lineitem)
SELECT (place // size)::BIGINT AS page, count(*) AS n_rows, min(place)::BIGINT AS first, max(place)::BIGINT AS last, min(l_orderkey) AS low, max(l_orderkey) AS high, sum(l_partkey * (place % 1000))::BIGINT AS mixed FROM p, n GROUP BY 1""")
def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15: an ordered result written once and read in seven pages."""
    ordered = table(spark, sf_dir, "lineitem").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount")
    kept = Pages.write(ordered, own_folder(spark, "pages"), rows_a_file=20_000)
    sums = [F.count("*").alias("n_rows"), F.min("place").alias("first"), F.max("place").alias("last"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high"), F.sum(F.col("l_partkey") * (F.col("place") % 1000)).alias("mixed")]
    return balanced_union([page.agg(*sums).select(F.lit(i).cast("long").alias("page"), "*") for i, page in enumerate(kept.pages(kept.rows // 7 + 1))])


SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS col_name, count(*) AS n_rows, count({c}) AS n_values, true AS card_near, {'NULL::BOOLEAN' if c == 'l_returnflag' else 'true'} AS median_near, true AS new_files_only FROM lineitem" for c in SKETCHED))
def card_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01, AGG-15: the line items come in two halves; the second run reads the second half alone, and the merged sketches are held to the exact figures of the whole."""
    items, data, kept = table(spark, sf_dir, "lineitem").select(*SKETCHED), own_folder(spark, "halves"), own_folder(spark, "sketches")
    read = []
    for half in (0, 1):
        items.where(F.col("l_orderkey") % 2 == half).write.mode("append").parquet(data)
        read.append(sketches.refresh(spark, data, kept, SKETCHED))
    apart = not set(read[0]) & set(read[1]) and not sketches.refresh(spark, data, kept, SKETCHED)
    found = sketches.merged(spark, data, kept, [0.5]).withColumn("median", F.col("quantiles")[0])
    # One row: the exact counts, and each median's share of rows below and up to it.
    medians = found.groupBy().agg(*(F.max(F.when(F.col("col_name") == c, F.col("median"))).alias(f"m_{c}") for c in SKETCHED))
    numbers = SKETCHED[:-1]
    exact = items.join(F.broadcast(medians)).agg(*(F.count_distinct(c).alias(f"d_{c}") for c in SKETCHED), *(F.avg((F.col(c) < F.col(f"m_{c}")).cast("int")).alias(f"l_{c}") for c in numbers), *(F.avg((F.col(c) <= F.col(f"m_{c}")).cast("int")).alias(f"u_{c}") for c in numbers))
    whole = exact.select(F.explode(F.array(*(F.struct(F.lit(c).alias("col_name"), F.col(f"d_{c}").alias("d"), *(F.col(f"{x}_{c}").alias(x) if c in numbers else F.lit(None).cast("double").alias(x) for x in "lu")) for c in SKETCHED))).alias("e")).select("e.*")
    near = F.abs(F.col("card") - F.col("d")) <= 3 * sketches.HLL_ERROR * F.col("d") + 1
    e = 2 * sketches.KLL_ERROR
    return found.join(whole, "col_name").select("col_name", "n_rows", "n_values", near.alias("card_near"), ((F.col("l") <= 0.5 + e) & (F.col("u") >= 0.5 - e)).alias("median_near"), F.lit(apart).alias("new_files_only"))
