"""Queries over table data: values, ledger, store, verification, grading, blueprints, text rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.ids import dotted_id, value_id
from ..operators import blueprint, dense, embed, grade, guard, nodes, questions, store, values, verify
from ..registry import fixture, given, query, table
from ..sources import metadata

SAMPLED = {"orders": ["o_orderstatus", "o_orderpriority"], "customer": ["c_mktsegment"], "part": ["p_type", "p_brand"], "events": ["event_type"], "documents": ["lang", "source"]}
RUN = "2024-01-01 00:00:00"


TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
#: The statement in an answer, and the rules that it must keep, in SQL; each takes the name of a column.
FENCE = r"'^```(?:sql)?\s*\n?(.*?)\n?```\s*$'"
INNER = "CASE WHEN regexp_matches({0}, " + FENCE + ", 'is') THEN " + TRIM.format("regexp_extract({0}, " + FENCE + ", 1, 'is')") + " ELSE {0} END"
VALID = r"regexp_matches({0}, '^(SELECT|WITH|INSERT|UPDATE|DELETE|CREATE|EXPLAIN)\b', 'i')"
SAFE = (
    r"(starts_with({0}, 'select') AND NOT contains(regexp_replace({0}, ';+$', ''), ';') AND NOT contains({0}, 'information_schema') AND NOT regexp_matches({0}, '\bsystem\s*\.') AND NOT regexp_matches({0}, '\b("
    + "|".join(X.FORBIDDEN_SQL)
    + r")\b') AND len(list_filter(regexp_extract_all({0}, '\b(?:from|join)\s+([`a-z0-9_.-]+)', 1), lambda r: NOT (starts_with(r, '`lake`') OR starts_with(r, 'lake.')))) = 0)"
)


def counts_sql(tables: dict[str, list[str]] = SAMPLED) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS tbl_name, '{c}' AS col_name, {c}::VARCHAR AS val, count(*) AS cnt FROM {t} WHERE {c} IS NOT NULL AND {c}::VARCHAR <> '' GROUP BY {c}" for t, cs in tables.items() for c in cs)


SAMPLE_SQL = f"""counts AS ({counts_sql()}), few AS (SELECT tbl_name, col_name FROM counts GROUP BY 1, 2 HAVING count(*) < 50),
top AS (SELECT *, row_number() OVER (PARTITION BY tbl_name, col_name ORDER BY cnt DESC, val) AS rn FROM counts JOIN few USING (tbl_name, col_name)),
sampled AS (SELECT 'lake.main.' || tbl_name || '.' || col_name AS col_id, col_name, val, cnt, tbl_name FROM top WHERE rn <= 10)"""


def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.sample({("lake", "main", t): (table(spark, sf_dir, t), cs) for t, cs in SAMPLED.items()}, exact=True)


@query("SELECT * FROM (VALUES ('l_orderkey', (SELECT count(DISTINCT l_orderkey) FROM lineitem)), ('l_partkey', (SELECT count(DISTINCT l_partkey) FROM lineitem)), ('l_returnflag', (SELECT count(DISTINCT l_returnflag) FROM lineitem)), ('l_linestatus', (SELECT count(DISTINCT l_linestatus) FROM lineitem))) t(col_name, card)")
def card_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.cardinalities(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"], exact=True)


@query()
def card_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: sketches differ between engines; the tests bound the error."""
    return values.cardinalities(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"])


@query(counts_sql({"lineitem": ["l_returnflag", "l_linestatus"], "orders": ["o_orderstatus", "o_orderpriority"]}))
def value_unpivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"lineitem": ["l_returnflag", "l_linestatus"], "orders": ["o_orderstatus", "o_orderpriority"]}
    return nodes.balanced_union([values.value_counts(table(spark, sf_dir, t), cs).withColumn("tbl_name", F.lit(t)) for t, cs in parts.items()])


@query(f"WITH {SAMPLE_SQL} SELECT col_id, val, cnt FROM sampled")
def value_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled(spark, sf_dir).select("col_id", "val", "cnt")


@query(f"WITH {SAMPLE_SQL} SELECT col_id || '.' || md5(val) AS id, val AS value, cnt AS count, 'lake' AS catalog, 'main' AS \"schema\", '{RUN}' AS last_run, '1.6' AS contract_version FROM sampled")
def value_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.value_nodes(sampled(spark, sf_dir), RUN)


@query(f"WITH {SAMPLE_SQL} SELECT col_id AS source_id, col_id || '.' || md5(val) AS target_id FROM sampled")
def has_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.has_value(sampled(spark, sf_dir).withColumn("id", value_id("col_id", "val")))


@query("""WITH s AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS i, count(*) OVER () AS m FROM s)
SELECT max(CASE WHEN i = 0 THEN n END) AS "min", max(CASE WHEN i = round_even(0.25 * (m - 1), 0) THEN n END) AS p25, max(CASE WHEN i = round_even(0.5 * (m - 1), 0) THEN n END) AS p50,
  max(CASE WHEN i = round_even(0.75 * (m - 1), 0) THEN n END) AS p75, max(CASE WHEN i = round_even(0.95 * (m - 1), 0) THEN n END) AS p95, max(CASE WHEN i = m - 1 THEN n END) AS "max" FROM r""")
def card_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.nearest_ranks(table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")), "n")


@query("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'nation', count(*) FROM nation")
def balanced_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.counts({t: table(spark, sf_dir, t) for t in ("orders", "customer", "part", "supplier", "nation")})


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey = 1 AND c_custkey = o_custkey)")
def semi_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = store.in_batch(table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, sf_dir, "nation").where("n_regionkey = 1").select("n_nationkey"), ["n_nationkey"])
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(customers.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")


@query("SELECT c_custkey AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.orphans(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("target_id")))


def _ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = embed.hashed(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("embedding_text"), "doc_id"))
    known = docs.where("doc_id % 2 = 0").select(
        "id", F.when(F.col("doc_id") % 10 == 0, F.sha2(F.lit("old"), 256)).otherwise(F.col("embedding_text_hash")).alias("embedding_text_hash"), F.array(F.col("doc_id").cast("double")).alias("embedding"),
        F.when(F.col("doc_id") % 14 == 0, "other").otherwise("model").alias("embedding_model"), F.lit(RUN).cast("timestamp").alias("embedded_at"),
    )
    return docs.drop("doc_id"), known


LEDGER = "doc AS (SELECT doc_id::VARCHAR AS id, doc_id, sha256(text) AS h FROM documents), led AS (SELECT id, doc_id, CASE WHEN doc_id % 10 = 0 THEN sha256('old') ELSE h END AS h, CASE WHEN doc_id % 14 = 0 THEN 'other' ELSE 'model' END AS m FROM doc WHERE doc_id % 2 = 0)"


@query(f"WITH {LEDGER} SELECT doc.id, (led.id IS NOT NULL) AS hit FROM doc LEFT JOIN led ON doc.id = led.id AND led.m = 'model' AND led.h = doc.h")
def ledger_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, known = _ledger(spark, sf_dir)
    hits, misses = embed.split_by_ledger(docs, known, "model")
    return hits.select("id", F.lit(True).alias("hit")).unionByName(misses.select("id", F.lit(False).alias("hit")))


@query(f"""WITH {LEDGER}, new AS (SELECT id, h, doc_id::DOUBLE + 0.5 AS v FROM doc WHERE doc_id % 3 = 0)
SELECT l.id, l.m AS embedding_model, l.h AS embedding_text_hash, l.doc_id::DOUBLE AS v FROM led l WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.id = l.id AND l.m = 'model') UNION ALL SELECT id, 'model', h, v FROM new""")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, known = _ledger(spark, sf_dir)
    n = F.col("id").cast("long")
    staged = docs.withColumns({"embedding": F.when(n % 3 == 0, F.array(n.cast("double") + 0.5)), "embedding_error": F.when(n % 3 == 1, "failed"), "embedding_model": F.lit("model"), "embedded_at": F.lit(RUN).cast("timestamp")})
    return embed.upserted_ledger(staged, known).select("id", "embedding_model", "embedding_text_hash", F.col("embedding")[0].alias("v"))


@query("""WITH s AS (SELECT 'doc' AS label, count(*) AS attempts, count(*) FILTER (WHERE doc_id % 7 <> 0) AS successes FROM documents UNION ALL SELECT 'page', count(*), count(*) FROM pages UNION ALL SELECT 'none', 0, 0)
SELECT label, attempts, successes, CASE WHEN attempts = 0 THEN 0.0e0 ELSE (attempts - successes) / attempts END AS failure_rate FROM (SELECT * FROM s UNION ALL SELECT '*', sum(attempts)::BIGINT, sum(successes)::BIGINT FROM s)""")
def embed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 7 != 0, F.array(F.lit(1.0))).alias("embedding"))
    pages = table(spark, sf_dir, "pages").select(F.array(F.lit(1.0)).alias("embedding"))
    return embed.failure_rates(nodes.balanced_union([embed.failure_stats(docs, "doc"), embed.failure_stats(pages, "page"), embed.failure_stats(docs.limit(0), "none")]))


@query("""SELECT vec_id, CASE WHEN vec_id % 5 = 1 THEN 'boom' WHEN vec_id % 5 = 2 THEN 'no vector' WHEN vec_id % 5 = 3 THEN 'dimension 3 instead of 64' END AS error, vec_id % 5 NOT IN (1, 2, 3) AS good FROM embeddings""")
def embedding_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("vec_id") % 5
    result = F.when(k == 2, F.lit(None)).when(k == 3, F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.struct(result.alias("result"), F.when(k == 1, "boom").alias("errorMessage")).alias("raw"))
    vector, error = embed.validated("raw", 64)
    return rows.select("vec_id", error.alias("error"), vector.isNotNull().alias("good"))


@query("""WITH w AS (SELECT item_id, unnest(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS w FROM benchmark),
b AS (SELECT item_id, ('0x' || left(md5(w), 8))::BIGINT % 16 AS place, count(*)::DOUBLE AS n FROM w GROUP BY 1, 2), t AS (SELECT item_id, sqrt(sum(n * n)) AS norm FROM b GROUP BY 1)
SELECT item_id, place, round(n / norm, 6) AS x FROM b JOIN t USING (item_id)""")
def hash_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(embed.hash_embedding(16)(F.col("text"))["result"]).alias("place", "x"))
    return rows.where("x > 0").select("item_id", F.col("place").cast("bigint").alias("place"), F.round("x", 6).alias("x"))


@query("SELECT o_orderkey::VARCHAR AS id FROM orders WHERE NOT (o_orderstatus IN ('F', 'O') AND o_orderdate < TIMESTAMP '1998-01-01')")
def stale_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("catalog"), F.lit("s").alias("schema"), F.col("o_orderdate").alias("last_run"))
    return store.without_stale(rows, "1998-01-01 00:00:00", ["F", "O"], ["s"]).select("id")


@query("SELECT DISTINCT l_orderkey::VARCHAR AS source_id, l_partkey::VARCHAR AS target_id FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F') AND EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 10)")
def edge_endpoint_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("source_id"), F.col("l_partkey").cast("string").alias("target_id"))
    sources = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("id"))
    targets = table(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").cast("string").alias("id"))
    return store.matched_edges(edges, sources, targets)


@query("SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS v FROM orders UNION ALL SELECT 'x', 'new'")
def node_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus")
    new = orders.where("o_orderstatus = 'F'").select("id", F.lit("new").alias("v")).unionByName(spark.range(2).select(F.lit("x").alias("id"), F.lit("new").alias("v")))
    return store.upsert(orders.select("id", F.lit("old").alias("v")), new, ["id"])


@query(f"WITH {SAMPLE_SQL}, n AS (SELECT 'Value' AS name, count(*) AS n FROM sampled UNION ALL SELECT 'HAS_VALUE', count(*) FROM sampled) SELECT * FROM n")
def graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sampled(spark, sf_dir).withColumn("id", value_id("col_id", "val"))
    return store.counts({"Value": values.value_nodes(s, RUN), "HAS_VALUE": nodes.has_value(s)})


CODES = [f"version:{x}" for x in ("Schema", "Table", "Column", "Value")] + ["orphan:Schema", "orphan:Table", "orphan:Column", "orphan:Value", "parents:Schema", "parents:Value", "type:Value", "limit:Value", "id:Value", "ends:REFERENCES", "confidence:REFERENCES"]
EXPECTED = {"orphan:Table": 1, "version:Table": 1, "id:Value": 5, "ends:REFERENCES": 1, "confidence:REFERENCES": 1}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', {EXPECTED.get(c, 0)}::BIGINT)" for c in CODES) + ") t(code, n)")
def verify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled graph into which five wrong values ids, a lost table, an old version and two bad edges are put."""
    snap = metadata.from_directory(spark, sf_dir)
    s = values.sample({("lake", "main", t): (table(spark, sf_dir, t), cs) for t, cs in {"orders": ["o_orderstatus", "o_orderpriority"], "customer": ["c_mktsegment"]}.items()}, exact=True).withColumn("id", value_id("col_id", "val"))
    wrong = F.when(F.col("col_name") == "o_orderpriority", F.concat(F.col("id"), F.lit("x"))).otherwise(F.col("id"))
    v = values.value_nodes(s, RUN).drop("id").withColumn("id", F.lit("")).limit(0).unionByName(s.select(F.col("val").alias("value"), F.col("cnt").alias("count"), F.col("tbl_catalog").alias("catalog"), F.col("tbl_schema").alias("schema"), F.lit(RUN).alias("last_run"), F.lit("1.6").alias("contract_version"), wrong.alias("id")))
    t = nodes.table_nodes(snap.tables).withColumn("contract_version", F.when(F.col("name") == "part", "1.5").otherwise(F.col("contract_version")))
    refs = spark.createDataFrame([("lake.main.orders.o_custkey", "lake.main.customer.c_custkey", 0.9), ("lake.main.orders.o_custkey", "lake.main.gone.x", 0.9), ("lake.main.part.p_name", "lake.main.part.p_size", 1.5)], "source_id string, target_id string, confidence double")
    return verify.verify(
        {"Schema": nodes.schema_nodes(snap.schemata), "Table": t, "Column": nodes.column_nodes(snap.columns), "Value": v},
        {"HAS_SCHEMA": nodes.has_schema(snap.schemata), "HAS_TABLE": nodes.has_table(snap.tables.where("table_name <> 'nation'")), "HAS_COLUMN": nodes.has_column(snap.columns), "HAS_VALUE": s.select(F.col("col_id").alias("source_id"), wrong.alias("target_id")), "REFERENCES": refs},
        "1.6",
    )


@query("SELECT 'part' AS name, 5::BIGINT AS expected, (SELECT count(*) FROM part) AS actual UNION ALL SELECT 'gone', 1, 0")
def count_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = spark.createDataFrame([("part", 5), ("gone", 1), ("region", 5)], "name string, n long")
    return verify.count_mismatches(expected, store.counts({t: table(spark, sf_dir, t) for t in ("part", "region")})).withColumn("actual", F.coalesce("actual", F.lit(0)))


def _graded(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    orders = table(spark, sf_dir, "orders")
    by = orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    keys = orders.select("o_orderkey", "o_custkey")
    return {
        "same": (by.select(F.col("n").alias("N"), F.upper("o_orderstatus").alias("s")), by),
        "extra_column": (by.withColumn("more", F.lit(1)), by),
        "alias_extra": (by.select(F.col("o_orderstatus").alias("a"), F.col("n").alias("b"), F.lit("zz").alias("c")), by),
        "other_values": (by.withColumn("n", F.col("n") + 1), by),
        "fewer_rows": (by.orderBy("o_orderstatus").limit(2), by),
        "large_same": (keys, keys),
        "large_superset": (keys.unionByName(keys.orderBy("o_orderkey").limit(5)), keys),
        "large_short": (keys.where("o_orderkey % 2 = 0"), keys),
        "large_other": (keys.withColumn("o_custkey", -F.col("o_custkey") - 1), keys),
        "large_near": (keys.withColumn("o_custkey", F.when(F.col("o_orderkey") % 10 == 3, -1).otherwise(F.col("o_custkey"))), keys),
    }


def _sides() -> str:
    """The rows of all pairs as SQL: (pair, variant, ours, row)."""
    cell = lambda c: f"lower(coalesce(({c})::VARCHAR, 'null'))" if c.startswith("o_order") or c.startswith("'") else f"coalesce(({c})::VARCHAR, 'NULL')"
    row = lambda *cs: "list_sort([" + ", ".join(map(cell, cs)) + "])"
    by, keys = ("o_orderstatus", "n"), ("o_orderkey", "o_custkey")
    few = "(SELECT * FROM by_status ORDER BY o_orderstatus LIMIT 2)"
    extra = [("o_orderstatus", "n"), ("o_orderstatus", "'zz'"), ("n", "'zz'")]
    given = {
        "same": [("by_status", 0, by)], "extra_column": [("by_status", 0, by)], "other_values": [("by_status", 0, ("o_orderstatus", "n + 1"))], "fewer_rows": [(few, 0, by)],
        "alias_extra": [("by_status", 0, (*by, "'zz'"))] + [("by_status", i, c) for i, c in enumerate(extra, 1)],
        "large_same": [("orders", 0, keys)], "large_superset": [("orders", 0, keys), ("(SELECT * FROM orders ORDER BY o_orderkey LIMIT 5)", 0, keys)],
        "large_short": [("(SELECT * FROM orders WHERE o_orderkey % 2 = 0)", 0, keys)], "large_other": [("orders", 0, ("o_orderkey", "-o_custkey - 1"))], "large_near": [("orders", 0, ("o_orderkey", "CASE WHEN o_orderkey % 10 = 3 THEN -1 ELSE o_custkey END"))],
    }
    parts = []
    for pair, sides in given.items():
        parts += [f"SELECT '{pair}' AS pair, {v} AS variant, 1 AS gn, 0 AS rn, {row(*cs)} AS r FROM {f} x" for f, v, cs in sides]
        parts += [f"SELECT '{pair}', {v}, 0, 1, {row(*(keys if pair.startswith('large') else by))} FROM {'orders' if pair.startswith('large') else 'by_status'}" for v in sorted({v for _, v, _ in sides})]
    return " UNION ALL ".join(parts)


@query(f"""WITH by_status AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1), sides AS ({_sides()}),
counts AS (SELECT pair, variant, r, sum(gn) AS gn, sum(rn) AS rn FROM sides GROUP BY ALL),
sums AS (SELECT pair, variant, sum(gn) AS g, sum(rn) AS n, sum(greatest(rn - gn, 0)) AS missing, sum(greatest(gn - rn, 0)) AS extra FROM counts GROUP BY ALL),
placed AS (SELECT s.pair, s.ours, s.r, row_number() OVER (PARTITION BY s.pair, s.ours ORDER BY s.r) - 1 AS place FROM (SELECT pair, gn = 1 AS ours, r FROM sides WHERE variant = 0) s),
sampled AS (SELECT a.pair, avg(coalesce(a.r = b.r, false)::INT) AS rate FROM placed a JOIN sums s ON a.pair = s.pair AND s.variant = 0 LEFT JOIN placed b ON a.pair = b.pair AND a.place = b.place AND NOT b.ours
  WHERE a.ours AND a.place % (s.g // least(50, s.g)) = 0 AND a.place // (s.g // least(50, s.g)) < least(50, s.g) GROUP BY a.pair)
SELECT pair, CASE WHEN greatest(g, n) >= 500 THEN NOT (g < n AND (n - g) / n > 0.1) AND ((g > n AND missing = 0) OR rate >= 0.8)
  ELSE g = n AND (missing + extra = 0 OR EXISTS (SELECT 1 FROM sums v WHERE v.pair = m.pair AND v.variant > 0 AND v.missing + v.extra = 0)) END AS correct
FROM sums m LEFT JOIN sampled USING (pair) WHERE variant = 0""")
def grade_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade.graded(_graded(spark, sf_dir)).select("pair", "correct")


@query("""WITH g AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0), r AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0)
SELECT (SELECT count(*) FROM g) AS n_gen, (SELECT count(*) FROM r) AS n_ref, (SELECT count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM g)) AS missing, (SELECT count(*) FROM (SELECT * FROM g EXCEPT ALL SELECT * FROM r)) AS extra""")
def multiset_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return grade.differences(grade.normal_rows(rows.where("o_orderkey % 3 <> 0").drop("o_orderkey")), grade.normal_rows(rows.where("o_orderkey % 2 = 0").drop("o_orderkey")))


@query(f"""WITH {given('arm_results')}, s AS (SELECT arm, count(*) AS attempted, count(*) FILTER (WHERE parsed) AS parsed, count(*) FILTER (WHERE executed) AS executed, count(*) FILTER (WHERE non_empty) AS non_empty, count(*) FILTER (WHERE correct) AS correct, count(correct) AS gradable FROM arm_results GROUP BY arm)
SELECT *, round(parsed / greatest(attempted, 1), 3) AS parse_rate, round(executed / greatest(attempted, 1), 3) AS execution_rate, round(non_empty / greatest(executed, 1), 3) AS non_empty_rate, round(correct / greatest(gradable, 1), 3) AS correct_rate FROM s""")
def arm_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade.arm_summary(fixture(spark, "arm_results", sf_dir))


SANE = "lower(regexp_replace(regexp_replace({0}, '[^a-zA-Z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g'))"


@query(f"SELECT page_id, CASE WHEN regexp_matches({SANE.format('url')}, '^[0-9]') THEN 't_' || {SANE.format('url')} ELSE {SANE.format('url')} END AS name, CASE WHEN regexp_matches({SANE.format('page_id::VARCHAR')}, '^[0-9]') THEN 'c_' || {SANE.format('page_id::VARCHAR')} END AS numbered FROM pages")
def sanitize_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.sanitize_identifier("url", "t").alias("name"), X.sanitize_identifier(F.col("page_id").cast("string"), "c").alias("numbered"))


@query("""WITH n AS (SELECT p_partkey, replace(p_name, ' ', '_') || '__' || p_brand AS body FROM part)
SELECT p_partkey, 'fk_' || body AS short, CASE WHEN length(body) <= 16 THEN 'fk_' || body ELSE 'fk_' || left(body, 3) || '_' || left(sha1('fk_' || body), 12) END AS cut FROM n""")
def constraint_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = (F.replace("p_name", F.lit(" "), F.lit("_")), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", X.constraint_name("fk", *parts).alias("short"), X.constraint_name("fk", *parts, limit=19).alias("cut"))


@query("SELECT conv_id, turn, CASE WHEN length(text) > 80 THEN left(text, 80) || '...' ELSE text END AS short, '''' || replace(replace(text, chr(92), chr(92) || chr(92)), '''', '''''') || '''' AS literal FROM conversations")
def short_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.short_value("text").alias("short"), F.when(F.col("text").isNotNull(), X.sql_literal("text")).alias("literal"))


@query("SELECT conv_id, turn, coalesce('''' || replace(replace(text, chr(92), chr(92) || chr(92)), '''', '''''') || '''', 'NULL') AS literal FROM conversations")
def sql_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With NULL for null, which short_values leaves null."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.sql_literal("text").alias("literal"))


@query(f"WITH {given('sql_texts')}, s AS (SELECT id, lower({TRIM.format('sql')}) AS s FROM sql_texts) SELECT id, {SAFE.format('s')} AS safe FROM s")
def sql_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixture(spark, "sql_texts", sf_dir)
    return texts.join(guard.judged(texts, "sql", "lake"), "sql").select("id", "safe")


@query(f"WITH {given('answers')}, c AS (SELECT id, {TRIM.format("coalesce(answer, '')")} AS c FROM answers), i AS (SELECT id, {INNER.format('c')} AS i FROM c) SELECT id, nullif(i, '') AS sql, {VALID.format('i')} AS valid FROM i")
def parse_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, "answers", sf_dir).select("id", X.parse_sql("answer").alias("p")).select("id", "p.sql", "p.valid")


@query("SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY trim(text) ORDER BY conv_id, turn) AS rn FROM conversations) WHERE rn = 1")
def question_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.first_of_sql(table(spark, sf_dir, "conversations"), "text", ["conv_id", "turn"])


@query(f"""WITH {given('batch_questions')}, c AS (SELECT question_id, {TRIM.format('sql')} AS s FROM batch_questions WHERE shape IS NULL OR shape <> 'window'),
g AS (SELECT question_id, s, row_number() OVER (PARTITION BY s ORDER BY question_id) AS n FROM (SELECT * FROM c WHERE {VALID.format('s')}) WHERE {SAFE.format('lower(s)')})
SELECT question_id, split_part(regexp_extract(s, '`[^`]+`.`[^`]+`.`[^`]+`'), '`', 4) AS "schema", s AS sql FROM g WHERE n = 1""")
def filter_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.filtered(fixture(spark, "batch_questions", sf_dir), ["window"], "lake").select("question_id", "schema", "sql")


@query(f"WITH {given('result_cells')} SELECT id, n_rows = 0 OR (n_rows = 1 AND n_columns = 1 AND (cell IS NULL OR cell IN ('', '0'))) AS trivial FROM result_cells")
def trivial_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, "result_cells", sf_dir).select("id", questions.trivial("n_rows", "n_columns", "cell").alias("trivial"))


@query(f"""WITH {given('asked')} SELECT question_id, 'Write one SQL SELECT that answers the question.' || chr(10) || 'The data is in catalog ''lake'', schemas ''a'', ''b''.' || chr(10) || 'Give only the SQL, with fully qualified names. Order rows only if asked to.' || chr(10) || chr(10) || 'Question: ' || question AS prompt FROM asked""")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.prompts(fixture(spark, "asked", sf_dir), "lake", ["a", "b"])


@query(rf"""WITH {given('ddl_scripts', 'edges_there')}, t AS (SELECT replace(lower(ddl), '`', '') AS d FROM ddl_scripts), e AS (
  SELECT regexp_extract(d, 'alter table ([a-z0-9._]+)', 1) || '.' || regexp_extract(d, 'foreign key \(([a-z0-9_]+)\)', 1) AS source_id, regexp_extract(d, 'references ([a-z0-9._]+)', 1) || '.' || regexp_extract(d, 'references [a-z0-9._]+ \(([a-z0-9_]+)\)', 1) AS target_id FROM t WHERE contains(d, 'foreign key'))
(SELECT *, 'missing' AS kind FROM (SELECT * FROM e EXCEPT SELECT * FROM edges_there)) UNION ALL (SELECT *, 'extra' FROM (SELECT * FROM edges_there EXCEPT SELECT * FROM e))""")
def reference_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.edge_diff(questions.declared_in_ddl(fixture(spark, "ddl_scripts", sf_dir)), fixture(spark, "edges_there", sf_dir))


@query("""SELECT id, position, catalog, layer FROM (VALUES (-1, 0, 'gold', 'g'), (-1, 1, 'silver', NULL), (-1, 3, 'bronze', 'b')) t(id, position, catalog, layer)
UNION ALL SELECT c_custkey, 0, c_mktsegment, c_nationkey::VARCHAR FROM customer UNION ALL SELECT c_custkey, 1, c_name, NULL FROM customer""")
def catalog_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-06."""
    return metadata.listed_catalogs(fixture(spark, "catalog_lists", sf_dir), "listed", ["id"])


@query(f"WITH {given('responses')} SELECT id, coalesce({', '.join(f"json_extract_string(r, '{path}')" for path in ('$.choices[0].message.content', '$.content[0].text', '$.result', '$.predictions[0]', '$.text'))}) AS sql FROM responses UNION ALL SELECT 1000000 + 1000 * conv_id + turn, text FROM conversations")
def generated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN-02: each turn of a conversation comes in one of the shapes that answers have."""
    text = F.col("text")
    shapes = [F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")), F.struct(F.array(F.struct(text)).alias("content")), F.struct(text.alias("result")), F.struct(F.array(text).alias("predictions")), F.struct(text)]
    shape = F.coalesce(*(F.when(F.col("turn") % len(shapes) == i, F.to_json(x)) for i, x in enumerate(shapes)))
    turns = table(spark, sf_dir, "conversations").select((1000000 + 1000 * F.col("conv_id") + F.col("turn")).alias("id"), shape.alias("r"))
    return fixture(spark, "responses").unionByName(turns).select("id", X.generated_text("r").alias("sql"))


#: Clean names and lake types of the fixture's columns; of several with one name the first.
PLANNED = f"""{given('plan_columns')}, raw AS (SELECT s, lower(trim(regexp_replace(t, '[^a-zA-Z0-9_]+', '_', 'g'), '_')) AS t, p, lower(trim(regexp_replace(c, '[^a-zA-Z0-9_]+', '_', 'g'), '_')) AS c, upper(d) AS d FROM plan_columns),
clean AS (SELECT s, CASE WHEN regexp_matches(t, '^[0-9]') THEN 't_' || t ELSE t END AS t, p, CASE WHEN regexp_matches(c, '^[0-9]') THEN 'c_' || c ELSE c END AS c, d FROM raw WHERE t <> '' AND c <> ''),
first_of AS (SELECT *, row_number() OVER (PARTITION BY s, t, c ORDER BY p) AS n FROM clean),
planned AS (SELECT s AS "schema", t AS "table", p AS place, c AS "column", CASE WHEN d = 'BIGINT' THEN 'BIGINT' WHEN d = 'INT' THEN 'INT' ELSE 'STRING' END AS lake_type, d NOT IN ('INT', 'BIGINT', 'TEXT') AND NOT starts_with(d, 'VARCHAR(') AS fallback FROM first_of WHERE n = 1)"""


def blueprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hand-made tables, and one for each twenty parts of a brand, whose first column is its key and refers to its second."""
    c = fixture(spark, "plan_columns", sf_dir).groupBy(F.col("s").alias("schema"), F.col("t").alias("table")).agg(F.array_sort(F.collect_list(F.struct("p", F.col("c").alias("name"), F.col("d").alias("type")))).alias("cs"))
    columns = F.transform("cs", lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"), F.lit(None).cast("string").alias("comment")))
    user, part = F.col("table") == "Users", F.col("schema") == "parts"
    rows = F.when(part, None).when(user, F.array(F.array(F.lit("1"), F.lit("a"), F.lit("b"), F.lit("c")))).otherwise(F.array(F.array(F.lit(None).cast("string"), F.lit("1"), F.lit("x"))))
    struct = lambda cols, parent, ref: F.struct(F.array(*cols).alias("columns"), parent.alias("foreign_table"), F.array(*ref).alias("referred_columns"))
    key = lambda cols, parent, ref: struct(map(F.lit, cols), F.lit(parent), map(F.lit, ref))
    name = lambda i: F.get("cs", F.lit(i))["name"]
    keys = F.when(part, F.array(struct([name(0)], F.col("table"), [F.coalesce(name(1), F.lit("gone"))]))).when(F.col("table") == "2 Orders", F.array(key(["user id"], "Users", ["ID"]), key(["gone"], "Users", ["ID"]), key(["id", "user id"], "Users", ["ID"]), key(["user id"], "Nowhere", ["ID"])))
    return c.select("schema", "table", columns.alias("columns"), F.array(F.when(part, name(0)).when(user, "ID").otherwise("id")).alias("primary_key"), keys.alias("foreign_keys"), rows.alias("rows"))


@query(f"WITH {PLANNED} SELECT * FROM planned")
def blueprint_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blueprint.planned_columns(blueprints(spark, sf_dir)).drop("comment")


#: Of the tables from parts, the first column and the second one (null if there is none).
PART_KEYS = """heads AS (SELECT "schema", "table", max(CASE place WHEN 0 THEN "column" END) AS a, max(CASE place WHEN 1 THEN "column" END) AS b FROM planned WHERE "schema" = 'parts' GROUP BY 1, 2)"""


@query(f"WITH {PLANNED}, {PART_KEYS} SELECT 'sp' AS \"schema\", 't_2_orders' AS \"table\", 'users' AS parent, 'fk_sp__t_2_orders__user_id__users' AS name UNION ALL SELECT \"schema\", \"table\", \"table\", 'fk_parts__' || \"table\" || '__' || a || '__' || \"table\" FROM heads WHERE b IS NOT NULL")
def blueprint_fk_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blueprints(spark, sf_dir)
    return blueprint.planned_foreign_keys(b, blueprint.planned_columns(b)).select("schema", "table", "parent", "name")


@query(f"WITH {PLANNED}, {PART_KEYS} SELECT 'sp' AS \"schema\", 'users' AS \"table\", 'pk_sp__users' AS name UNION ALL SELECT \"schema\", \"table\", 'pk_parts__' || \"table\" FROM heads")
def blueprint_pk_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blueprints(spark, sf_dir)
    return blueprint.planned_primary_keys(b, blueprint.planned_columns(b)).select("schema", "table", "name")


@query(f"WITH {PLANNED} SELECT \"schema\", \"table\", 'CREATE TABLE `lake`.`' || \"schema\" || '`.`' || \"table\" || '` (' || string_agg('`' || \"column\" || '` ' || lake_type, ', ' ORDER BY place) || ')' AS ddl FROM planned GROUP BY 1, 2")
def ddl_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blueprint.statements(blueprint.planned_columns(blueprints(spark, sf_dir)), "lake")


@query(f"""WITH {PLANNED}, {PART_KEYS} SELECT 'sp' AS "schema", 'users' AS "table", 'CREATE TABLE `lake`.`sp`.`users` (`id` INT NOT NULL, `full_name` STRING, CONSTRAINT `pk_sp__users` PRIMARY KEY (`id`))' AS ddl
UNION ALL SELECT 'sp', 't_2_orders', 'CREATE TABLE `lake`.`sp`.`t_2_orders` (`id` BIGINT, `user_id` INT, `c_9lives` STRING)' UNION ALL SELECT 'sp', 't_2_orders', 'ALTER TABLE `lake`.`sp`.`t_2_orders` ADD CONSTRAINT `fk_sp__t_2_orders__user_id__users` FOREIGN KEY (`user_id`) REFERENCES `lake`.`sp`.`users` (`id`)'
UNION ALL SELECT 'sp', 'users', 'INSERT OVERWRITE `lake`.`sp`.`users` (`id`, `full_name`) VALUES (CAST(''1'' AS INT), ''a'')' UNION ALL SELECT 'sp', 't_2_orders', 'INSERT OVERWRITE `lake`.`sp`.`t_2_orders` (`id`, `user_id`, `c_9lives`) VALUES (NULL, CAST(''1'' AS INT), ''x'')'
UNION ALL SELECT "schema", "table", 'CREATE TABLE `lake`.`parts`.`' || "table" || '` (' || string_agg('`' || "column" || '` ' || lake_type || CASE place WHEN 0 THEN ' NOT NULL' ELSE '' END, ', ' ORDER BY place) || ', CONSTRAINT `pk_parts__' || "table" || '` PRIMARY KEY (`' || first("column" ORDER BY place) || '`))' FROM planned WHERE "schema" = 'parts' GROUP BY 1, 2
UNION ALL SELECT "schema", "table", 'ALTER TABLE `lake`.`parts`.`' || "table" || '` ADD CONSTRAINT `fk_parts__' || "table" || '__' || a || '__' || "table" || '` FOREIGN KEY (`' || a || '`) REFERENCES `lake`.`parts`.`' || "table" || '` (`' || b || '`)' FROM heads WHERE b IS NOT NULL""")
def ddl_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blueprints(spark, sf_dir)
    planned = blueprint.planned_columns(b)
    created = blueprint.statements(planned, "lake", blueprint.planned_primary_keys(b, planned))
    return created.unionByName(blueprint.foreign_key_statements(blueprint.planned_foreign_keys(b, planned), "lake").drop("name")).unionByName(blueprint.insert_statements(b, planned, "lake"))


@query("SELECT p_brand AS brand, p_size AS size, count(*) AS n_rows FROM part GROUP BY 1, 2")
def zipped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-05: the parts of each brand and size as lists of columns, zipped to rows again and counted."""
    lists = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).agg(F.array(F.collect_list(F.col("p_partkey").cast("string")), F.collect_list("p_name")).alias("lists"))
    return lists.select("brand", "size", F.size(blueprint.zipped_rows("lists", 1_000_000_000)).cast("long").alias("n_rows"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their counts as maps; a run without counts of the graph has an empty map."""
    x = fixture(spark, "runs", sf_dir)
    long = lambda *pairs: F.create_map(*(v for k, c in pairs for v in (F.lit(k), F.col(c).cast("long"))))
    counts = long(("schemas", "s"), ("tables", "t"), ("fk_declared", "d"), ("fk_edges", "e"), ("sampled_columns", "sampled"), ("skipped_columns", "skipped"), ("candidate_columns", "candidates"))
    return x.withColumns({"row_counts": counts, "graph_counts": F.when(F.col("g") > 0, long(("Table", "g"))).otherwise(F.create_map().cast("map<string,bigint>"))})


@query(f"""WITH {given('runs')}, r AS (SELECT * FROM runs) SELECT 'status_not_success' AS code, count(*) FILTER (status IS NULL OR status <> 'success') AS n FROM r UNION ALL SELECT 'missing_run_id', count(*) FILTER (coalesce(run_id, '') = '') FROM r UNION ALL SELECT 'missing_row_counts', 0
UNION ALL SELECT 'sampled_exceeds_candidates', count(*) FILTER (sampled > candidates) FROM r UNION ALL SELECT 'sampled_and_skipped_are_not_candidates', count(*) FILTER (sampled + skipped <> candidates) FROM r
UNION ALL SELECT 'status', count(*) FILTER (status IS NULL OR status <> 'success') FROM r UNION ALL SELECT 'error', count(error) FROM r UNION ALL SELECT 'few:schemas', count(*) FILTER (s < 4) FROM r UNION ALL SELECT 'few:tables', count(*) FILTER (t < 19) FROM r
UNION ALL SELECT 'few:fk_declared', count(*) FILTER (d < 16) FROM r UNION ALL SELECT 'few:fk_edges', count(*) FILTER (e < 16) FROM r UNION ALL SELECT 'no_graph_counts', count(*) FILTER (g = 0) FROM r""")
def summary_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VER-01, VER-08, VER-14."""
    runs = _runs(spark, sf_dir)
    return verify.summary_shape(runs).unionByName(verify.sampling_accounting(runs)).unionByName(verify.thresholds(runs))


@query(f"WITH {given('runs')}, r AS (SELECT * FROM runs) SELECT fk_declared, fk_resolved, fk_skipped FROM r WHERE fk_skipped <> fk_declared - fk_resolved OR fk_resolved > fk_declared OR fk_skipped < 0")
def fk_accounting_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VER-06."""
    return verify.fk_accounting(_runs(spark, sf_dir)).select("fk_declared", "fk_resolved", "fk_skipped")


@query("SELECT o_custkey::VARCHAR AS id FROM orders WHERE o_custkey % 7 = 0 EXCEPT SELECT c_custkey::VARCHAR FROM customer WHERE c_mktsegment <> 'BUILDING'")
def id_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VER-12: ids that orders name, and that the catalog (here customers outside one segment) lacks."""
    asked = table(spark, sf_dir, "orders").where("o_custkey % 7 = 0").select(F.col("o_custkey").cast("string").alias("id")).distinct()
    return verify.id_mismatches(table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("id")), asked)


@query("SELECT vec_id::VARCHAR AS id, 'ARRAY<FLOAT>' AS expected, CASE WHEN label % 3 = 0 THEN 'ARRAY<DOUBLE>' END AS data_type FROM embeddings WHERE label % 3 < 2")
def type_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VER-13: of columns of a complex type, those that came through as another or not at all."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "label")
    stored = v.where("label % 3 <> 1").select("id", F.when(F.col("label") % 3 == 0, "ARRAY<DOUBLE>").otherwise("ARRAY<FLOAT>").alias("data_type"))
    return verify.type_mismatches(v.select("id", F.lit("ARRAY<FLOAT>").alias("data_type")), stored)


@query("SELECT o_orderkey AS id, o_orderdate AS created, o_totalprice AS amount FROM orders")
def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-12: columns and a struct's field under new names."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.struct(F.col("o_orderdate").alias("at"), F.col("o_totalprice").alias("price")).alias("deal"), "o_custkey")
    return nodes.rename(rows, {"id": "o_orderkey", "created": "deal.at", "amount": "deal.price"})


@query("SELECT l_orderkey::VARCHAR AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11."""
    return store.duplicate_ids(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id")))


@query("""WITH t AS (SELECT p_brand || '.SQL' AS source_id, p_type, count(*) AS n FROM part GROUP BY 1, 2), s AS (SELECT source_id, count(*) AS n_tables, sum(n)::BIGINT AS n_fks FROM t GROUP BY 1),
r AS (SELECT *, round(n_fks / n_tables, 6) AS density FROM s WHERE n_tables BETWEEN 2 AND 50 AND n_fks >= 3), k AS (SELECT *, row_number() OVER (ORDER BY density DESC, source_id) AS rank FROM r)
SELECT source_id, n_tables, n_fks, density, rank::INTEGER AS rank, 'sp_' || lower(replace(replace(source_id, '.SQL', ''), '#', '_')) AS "schema" FROM k WHERE rank <= 10""")
def candidate_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").groupBy(F.concat("p_brand", F.lit(".SQL")).alias("source_id"), F.col("p_type").alias("table")).agg(F.count("*").alias("n_fks"), F.count("*").alias("n_rows"))
    return blueprint.ranked_candidates(t, 2, 50, 3, 10)


@query(f"""WITH {given('terms')}, r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY required DESC, md5('5|' || term), term) AS rn FROM terms), k(kind, n, fks) AS (VALUES ('entity', 5, 1), ('event', 5, 2), ('lines', 4, 1), ('config', 4, 1), ('analytics', 5, 1), ('approval', 4, 2), ('notification', 5, 2), ('integration', 4, 1), ('schedule', 4, 1), ('archive', 4, 2))
SELECT domain || '_' || term || CASE kind WHEN 'entity' THEN '' ELSE '_' || kind END AS "table", n::BIGINT AS n_columns, fks::BIGINT AS n_fks FROM r, k WHERE rn <= 2""")
def dense_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = dense.dense_tables(spark, dense.selected_terms(fixture(spark, "terms", sf_dir), 5, 2))
    return columns.groupBy("table").agg(F.count("*").alias("n_columns"), F.count("parent").alias("n_fks"))


@query(f"""WITH {given('terms')}, n AS (SELECT domain, term, domain || '_' || term AS t FROM terms WHERE domain NOT IN ('hr', 'crm') OR term = 'leads')
SELECT t AS "table", '- ' || t || '(id BIGINT, name STRING, status STRING, owner_id BIGINT, created_at TIMESTAMP) PK(id) FKs: owner_id->hr_employees' AS line FROM n
UNION ALL SELECT t || '_event', '- ' || t || '_event(id BIGINT, ' || term || '_id BIGINT, actor_id BIGINT, event_type STRING, occurred_at TIMESTAMP) PK(id) FKs: ' || term || '_id->' || t || ', actor_id->sys_users' FROM n
UNION ALL SELECT t || '_lines', '- ' || t || '_lines(id BIGINT, ' || term || '_id BIGINT, quantity INT, amount DECIMAL(14,2)) PK(id) FKs: ' || term || '_id->' || t FROM n""")
def ddl_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = fixture(spark, "terms", sf_dir).where("domain NOT IN ('hr', 'crm') OR term = 'leads'")
    return dense.ddl_prompt(dense.dense_tables(spark, terms, dense.TEMPLATES[:3]))


@query(f"WITH {given('terms')} SELECT count(*) * 100 AS n_rows, count(*) * 10 AS n_tables FROM terms")
def dense_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-DENSEGEN: ten rows of each of the ten tables of every term."""
    rows = dense.dense_rows(spark, dense.dense_tables(spark, fixture(spark, "terms", sf_dir)))
    return rows.where("column = 'id' and value is not null").agg(F.count("*").alias("n_rows"), F.count_distinct("table").alias("n_tables"))


@query("SELECT doc_id, lower('Lake.' || lang || '.' || source) AS id, lower('Lake.' || lang || '.' || source) || '.' || md5(n_chars::VARCHAR) AS value_id FROM documents")
def dotted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = dotted_id(F.lit("Lake"), "lang", F.lit(None).cast("string"), "source")
    return table(spark, sf_dir, "documents").select("doc_id", own.alias("id"), value_id(own, "n_chars").alias("value_id"))
