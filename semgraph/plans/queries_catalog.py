"""Queries over catalog metadata: nodes, edges, types, keys and foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import in_catalogs, in_schemas
from ..functions.text import comment_tokens
from ..functions.types import canonical_type, coerce_type
from ..operators import fk, nodes, retrieve, values
from ..registry import fixture, given, query, table
from ..sources import found, metadata

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
META = f"""meta AS (
  SELECT DISTINCT 'lake' AS table_catalog, 'main' AS table_schema, table_name, column_name,
    CASE data_type WHEN 'VARCHAR' THEN 'STRING' WHEN 'INTEGER' THEN 'INT' WHEN 'TIMESTAMP' THEN 'TIMESTAMP_NTZ' WHEN 'FLOAT[]' THEN 'ARRAY<FLOAT>' ELSE data_type END AS data_type,
    'YES' AS is_nullable, column_index::INTEGER AS ordinal_position, NULL::VARCHAR AS comment
  FROM duckdb_columns() WHERE NOT internal AND table_name IN {NAMES}
)"""
#: The same with logical names: ``c_custkey`` of customer is ``custkey``.
STRIPPED = META.replace("meta AS (", "raw AS (") + r""", meta AS (
  SELECT table_catalog, table_schema, table_name, regexp_replace(column_name, '^(' || left(table_name, 1) || '|' || left(table_name, 2) || ')_', '') AS column_name, data_type, is_nullable, ordinal_position, comment FROM raw
)"""
CANON = r"""CASE WHEN regexp_matches(upper(trim({0})), '^(STRING|VARCHAR|CHAR)(\([0-9]+\))?$') THEN 'STRING'
  WHEN regexp_matches(upper(trim({0})), '^(DECIMAL|NUMERIC)\(([0-9]+)(,([0-9]+))?\)$') THEN 'DECIMAL|' || coalesce(nullif(regexp_extract(upper(trim({0})), '^(DECIMAL|NUMERIC)\(([0-9]+)(,([0-9]+))?\)$', 4), ''), '0')
  WHEN upper(trim({0})) IN ('BIGINT','INT','INTEGER','LONG','SMALLINT','TINYINT') THEN 'INTEGER' ELSE upper(trim({0})) END"""
TOKENS = "list_filter(string_split_regex(lower(coalesce({0}, '')), '[^a-zA-Z0-9]+'), lambda t: length(t) >= 4 AND NOT list_contains(['the','of','and','a','an','to','for','id','column','table'], t))"


def snapshot(spark: SparkSession, sf_dir: str, stripped: bool = False) -> metadata.Snapshot:
    return metadata.from_directory(spark, sf_dir, rename=metadata.strip_prefix) if stripped else metadata.from_directory(spark, sf_dir)


@query(f"WITH {META} SELECT table_name, column_name, data_type, ordinal_position, {CANON.format('data_type')} AS canon FROM meta")
def meta_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.scoped(snapshot(spark, sf_dir), ["main"]).columns.select("table_name", "column_name", "data_type", "ordinal_position", canonical_type("data_type").alias("canon"))


@query("SELECT 'lake' AS id, 'lake' AS name, '1.6' AS contract_version")
def database_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.project(nodes.database_nodes(snapshot(spark, sf_dir).schemata), "Database")


@query("SELECT 'lake.main' AS id, 'main' AS name, NULL::VARCHAR AS comment, '1.6' AS contract_version, 'lake.main' AS embedding_text")
def schema_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.schema_nodes(snapshot(spark, sf_dir).schemata)


@query(f"WITH {META} SELECT DISTINCT lower('lake.main.' || table_name) AS id, table_name AS name, 'lake' AS catalog, 'main' AS \"schema\", 'gold' AS layer, 'EXTERNAL' AS table_type, '1.6' AS contract_version, 'lake.main.' || table_name AS embedding_text FROM meta")
def table_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.table_nodes(snapshot(spark, sf_dir).tables, {"lake": "gold"}).drop("comment", "created", "last_altered")


@query(f"""WITH {META} SELECT lower('lake.main.' || table_name || '.' || column_name) AS id, column_name AS name, 'lake' AS catalog, 'main' AS "schema", table_name AS "table", data_type, true AS is_nullable, ordinal_position,
  '1.6' AS contract_version, 'lake.main.' || table_name || '.' || column_name || ' | ' || data_type AS embedding_text FROM meta""")
def column_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.column_nodes(snapshot(spark, sf_dir).columns).drop("comment")


@query("SELECT 'lake' AS source_id, 'lake.main' AS target_id")
def has_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.has_schema(snapshot(spark, sf_dir).schemata)


@query(f"WITH {META} SELECT DISTINCT 'lake.main' AS source_id, lower('lake.main.' || table_name) AS target_id FROM meta")
def has_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.has_table(snapshot(spark, sf_dir).tables)


@query(f"WITH {META} SELECT lower('lake.main.' || table_name) AS source_id, lower('lake.main.' || table_name || '.' || column_name) AS target_id FROM meta")
def has_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.has_column(snapshot(spark, sf_dir).columns)


@query(f"WITH {given('type_names')} SELECT t, {CANON.format('t')} AS canon FROM type_names")
def canonical_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, "type_names", sf_dir).select("t", canonical_type("t").alias("canon"))


@query(f"""WITH {given('vendor_types')}, n AS (SELECT t, trim(trim(trim(upper(t)), ';')) AS u FROM vendor_types),
m AS (SELECT *, trim(split_part(u, '(', 1)) AS b, regexp_extract(u, '^(DECIMAL|NUMERIC|NUMBER|DEC)\\s*\\(([0-9]+)\\s*,\\s*([0-9]+)\\)$', 2) AS p, regexp_extract(u, '^(DECIMAL|NUMERIC|NUMBER|DEC)\\s*\\(([0-9]+)\\s*,\\s*([0-9]+)\\)$', 3) AS s FROM n),
k AS (SELECT *, CASE WHEN p <> '' THEN 'DECIMAL(' || greatest(1, least(p::INT, 38)) || ',' || least(s::INT, greatest(1, least(p::INT, 38))) || ')'
  WHEN regexp_matches(u, '^(VARCHAR|CHAR|CHARACTER|NVARCHAR|NCHAR)\\s*\\(') THEN 'STRING'
  ELSE CASE replace(b, ' ', '') WHEN 'INT' THEN 'INT' WHEN 'DOUBLEPRECISION' THEN 'DOUBLE' WHEN 'UNSIGNEDBIGINT' THEN 'DECIMAL(20,0)' WHEN 'TIMESTAMPWITHOUTTIMEZONE' THEN 'TIMESTAMP' WHEN 'BIT' THEN 'BOOLEAN'
    WHEN 'TEXT' THEN 'STRING' WHEN 'MONEY' THEN 'DECIMAL(18,4)' WHEN 'ENUM' THEN 'STRING' WHEN 'NUMERIC' THEN 'DECIMAL(18,4)' END END AS f FROM m)
SELECT t, coalesce(f, 'STRING') AS lake_type, f IS NULL AS fallback FROM k""")
def type_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, "vendor_types", sf_dir).select("t", coerce_type("t").alias("k")).select("t", "k.lake_type", "k.fallback")


def gate_sql(meta: str, keys: str) -> str:
    """Common table expressions gate and frame over the named relations."""
    return f"""frame AS (SELECT lower(concat_ws('.', table_catalog, table_schema, table_name, column_name)) AS col_id, lower(concat_ws('.', table_catalog, table_schema, table_name)) AS table_key,
    table_catalog, table_schema, lower(table_name) AS tn, lower(column_name) AS cn, {CANON.format('data_type')} AS canon, {TOKENS.format('comment')} AS tokens FROM {meta}),
  pk AS (SELECT lower(concat_ws('.', table_catalog, table_schema, table_name, min(column_name))) AS col_id FROM {keys} WHERE constraint_type = 'PRIMARY KEY' GROUP BY table_catalog, table_schema, table_name, constraint_name HAVING count(*) = 1),
  uq AS (SELECT DISTINCT lower(concat_ws('.', table_catalog, table_schema, table_name, column_name)) AS col_id FROM {keys} WHERE constraint_type = 'UNIQUE' AND ordinal_position = 1),
  ids AS (SELECT table_key, count(*) FILTER (WHERE suffix(cn, '_id')) AS n FROM frame GROUP BY table_key),
  gate AS (SELECT * FROM (SELECT f.col_id, CASE WHEN f.col_id IN (SELECT col_id FROM pk) THEN 'declared_pk' WHEN f.col_id IN (SELECT col_id FROM uq) OR cn = 'id' OR (cn = tn || '_id' AND ids.n = 1) THEN 'unique_or_heur' END AS pk_evidence
    FROM frame f JOIN ids USING (table_key)) WHERE pk_evidence IS NOT NULL)"""


def infer_sql(meta: str, keys: str) -> str:
    """Common table expressions up to ``edges``, the inferred foreign keys."""
    return gate_sql(meta, keys) + """,
  sk AS (SELECT *, 'exact' AS kind, 'E|' || cn AS lk FROM frame
    UNION ALL SELECT frame.*, 'suffix', 'S|' || left(cn, length(cn) - length(x)) FROM frame, (VALUES ('_id'), ('_fk'), ('_ref')) v(x) WHERE suffix(cn, x) AND length(cn) > length(x)),
  tk AS (SELECT *, 'exact' AS kind, 'E|' || cn AS lk FROM frame UNION ALL SELECT *, 'suffix', 'S|' || tn FROM frame WHERE cn = 'id'
    UNION ALL SELECT frame.*, 'suffix', 'S|' || left(tn, length(tn) - length(x)) FROM frame, (VALUES ('s'), ('es')) v(x) WHERE cn = 'id' AND suffix(tn, x) AND length(tn) > length(x)),
  cand AS (SELECT s.col_id AS source_id, t.col_id AS target_id, s.kind, s.canon AS sc, t.canon AS tc, len(list_intersect(s.tokens, t.tokens)) > 0 AS shared,
      row_number() OVER (PARTITION BY s.col_id, t.col_id ORDER BY CASE s.kind WHEN 'exact' THEN 0 ELSE 1 END) AS rn
    FROM sk s JOIN tk t ON s.table_catalog = t.table_catalog AND s.table_schema = t.table_schema AND s.kind = t.kind AND s.lk = t.lk AND s.col_id <> t.col_id AND NOT (s.cn = 'id' AND t.cn = 'id')),
  scored AS (SELECT source_id, target_id, CASE WHEN kind = 'exact' AND pk_evidence = 'declared_pk' THEN CASE WHEN shared THEN 0.95e0 ELSE 0.90e0 END
      WHEN kind = 'exact' THEN CASE WHEN shared THEN 0.88e0 ELSE 0.83e0 END WHEN pk_evidence = 'declared_pk' THEN CASE WHEN shared THEN 0.88e0 ELSE 0.83e0 END ELSE CASE WHEN shared THEN 0.82e0 ELSE 0.78e0 END END AS score
    FROM cand JOIN gate ON target_id = gate.col_id WHERE rn = 1 AND sc = tc),
  spread AS (SELECT source_id, target_id, score / greatest(1.0e0, sqrt(count(*) OVER (PARTITION BY source_id) - 1)) AS confidence FROM scored WHERE score >= 0.8e0),
  edges AS (SELECT source_id, target_id, round(confidence, 4) AS confidence, 'inferred_metadata' AS source FROM spread WHERE confidence >= 0.8e0)"""


def _infer(columns: DataFrame, keys: DataFrame) -> DataFrame:
    frame = nodes.columns_frame(columns)
    return fk.infer(frame, fk.pk_gate(frame, keys, whole=True)).drop("criteria")


@query(f"WITH {given('shop_columns', 'shop_keys')}, {gate_sql('shop_columns', 'shop_keys')} SELECT col_id, pk_evidence FROM gate")
def pk_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk.pk_gate(nodes.columns_frame(fixture(spark, "shop_columns", sf_dir)), fixture(spark, "shop_keys", sf_dir))


#: Columns that may be keys of the given tables, best first, and those that may refer to them.
KEYS = {
    "region": [["r_regionkey"], ["r_name"]], "nation": [["n_nationkey"], ["n_name"], ["n_regionkey"]], "customer": [["c_custkey"], ["c_name"]], "supplier": [["s_suppkey"], ["s_name"]], "part": [["p_partkey"], ["p_name", "p_brand"]],
    "orders": [["o_orderkey"], ["o_custkey", "o_orderdate"]], "lineitem": [["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]], "events": [["event_id"], ["user_id", "ts"]],
    "documents": [["doc_id"], ["text"]], "labels": [["doc_id"]], "pages": [["page_id"], ["url"]], "conversations": [["conv_id"], ["conv_id", "turn"]],
}
REFERENCES = [
    ("nation", ["n_regionkey"], "region", ["r_regionkey"]), ("customer", ["c_nationkey"], "nation", ["n_nationkey"]), ("supplier", ["s_nationkey"], "nation", ["n_nationkey"]), ("orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("lineitem", ["l_orderkey"], "orders", ["o_orderkey"]), ("lineitem", ["l_partkey"], "part", ["p_partkey"]), ("lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]), ("lineitem", ["l_orderkey", "l_linenumber"], "lineitem", ["l_orderkey", "l_linenumber"]),
    ("events", ["user_id"], "supplier", ["s_suppkey"]), ("labels", ["doc_id"], "documents", ["doc_id"]), ("documents", ["doc_id"], "labels", ["doc_id"]), ("part", ["p_size"], "nation", ["n_nationkey"]), ("conversations", ["turn"], "conversations", ["turn"]),
]


def _key_sql(name: str, place: int, columns: list[str]) -> str:
    null = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"SELECT '{name}' AS table_name, {place} AS place, {columns} AS cs, (SELECT count(*) = count(DISTINCT ({', '.join(columns)})) AND count(*) FILTER ({null}) = 0 FROM {name}) AS ok"


FOUND_KEYS = f"""tried AS ({" UNION ALL ".join(_key_sql(n, i, cs) for n, keys in KEYS.items() for i, cs in enumerate(keys))}),
keys AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY place) AS nth FROM tried WHERE ok)"""


def _reference_sql(child: str, columns: list[str], parent: str, referred: list[str]) -> str:
    outside = f"SELECT 1 FROM {child} c WHERE {' AND '.join(f'c.{x} IS NOT NULL' for x in columns)} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {' AND '.join(f'c.{x} = p.{y}' for x, y in zip(columns, referred, strict=True))})"
    return f"SELECT '{child}' AS child, {columns} AS cs, '{parent}' AS parent, {referred} AS rs WHERE NOT EXISTS ({outside})"


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in KEYS}


@query(f"WITH {FOUND_KEYS} SELECT table_name, unnest(cs) AS column_name, CASE nth WHEN 1 THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS constraint_type, unnest(range(1, len(cs) + 1))::INTEGER AS ordinal_position FROM keys")
def key_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-04, JOIN-06: of keys that the tables' rows bear out."""
    return metadata.key_constraints(*found.keys(_tables(spark, sf_dir), KEYS)).select("table_name", "column_name", "constraint_type", "ordinal_position")


@query(f"WITH {FOUND_KEYS} SELECT count(*) AS composite_pks FROM keys WHERE nth = 1 AND len(cs) > 1")
def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04."""
    return fk.composite_keys(metadata.key_constraints(*found.keys(_tables(spark, sf_dir), KEYS)))


@query(f"""WITH {FOUND_KEYS}, refs AS ({" UNION ALL ".join(_reference_sql(*r) for r in REFERENCES)}), pairs AS (SELECT child, parent, unnest(r.cs) AS c, unnest(r.rs) AS p FROM refs r JOIN keys k ON k.table_name = r.parent AND k.cs = r.rs)
SELECT 'lake.main.' || child || '.' || c AS source_id, 'lake.main.' || parent || '.' || p AS target_id, 1.0e0 AS confidence, 'declared' AS source FROM pairs""")
def fk_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05, JOIN-07, OP-FKDECL: references that the tables' rows bear out; one to columns that are no key stays unresolved."""
    tables = _tables(spark, sf_dir)
    _, usage = found.keys(tables, KEYS)
    referential, more = found.references(tables, REFERENCES)
    return fk.declared(metadata.declared_pairs(referential, usage.unionByName(more))).drop("criteria")


@query(f"WITH {STRIPPED}, {given('constraints')}, {infer_sql('meta', 'constraints')} SELECT * FROM edges")
def fk_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _infer(snapshot(spark, sf_dir, stripped=True).columns, fixture(spark, "constraints"))


@query(f"WITH {META}, {given('constraints')}, {infer_sql('meta', 'constraints')} SELECT * FROM edges")
def fk_infer_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _infer(snapshot(spark, sf_dir).columns, fixture(spark, "constraints"))


@query(f"WITH {given('shop_columns', 'shop_keys')}, {infer_sql('shop_columns', 'shop_keys')} SELECT * FROM edges")
def fk_infer_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _infer(fixture(spark, "shop_columns", sf_dir), fixture(spark, "shop_keys", sf_dir))


@query(f"WITH {given('fan_columns', 'fan_keys')}, {infer_sql('fan_columns', 'fan_keys')} SELECT * FROM edges")
def fk_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _infer(fixture(spark, "fan_columns", sf_dir), fixture(spark, "fan_keys", sf_dir))


PAIRS = """pairs AS (SELECT rc.constraint_schema AS fk_schema, rc.constraint_name AS fk_name, s.table_catalog AS sc, s.table_schema AS ss, s.table_name AS st, s.column_name AS s_c, t.table_catalog AS tc, t.table_schema AS ts, t.table_name AS tt, t.column_name AS t_c
  FROM referential rc JOIN key_usage s ON rc.constraint_catalog = s.constraint_catalog AND rc.constraint_schema = s.constraint_schema AND rc.constraint_name = s.constraint_name
  JOIN key_usage t ON rc.unique_constraint_catalog = t.constraint_catalog AND rc.unique_constraint_schema = t.constraint_schema AND rc.unique_constraint_name = t.constraint_name AND t.ordinal_position = s.position_in_unique_constraint)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.declared_pairs(fixture(spark, "referential", sf_dir), fixture(spark, "key_usage", sf_dir))


@query(f"WITH {given('referential', 'key_usage')}, {PAIRS} SELECT lower(concat_ws('.', sc, ss, st, s_c)) AS source_id, lower(concat_ws('.', tc, ts, tt, t_c)) AS target_id, 1.0e0 AS confidence, 'declared' AS source FROM pairs WHERE fk_schema IN ('sales') AND ts IN ('sales')")
def fk_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk.declared(_pairs(spark, sf_dir), ["sales"]).drop("criteria")


@query(f"WITH {given('referential', 'key_usage')}, {PAIRS} SELECT (SELECT count(*) FROM referential) AS fk_declared, count(DISTINCT (sc, fk_schema, fk_name)) AS fk_resolved, (SELECT count(*) FROM referential) - count(DISTINCT (sc, fk_schema, fk_name)) AS fk_skipped, count(*) AS fk_edges FROM pairs")
def fk_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk.accounting(fixture(spark, "referential", sf_dir), _pairs(spark, sf_dir))


@query(f"WITH {given('referential', 'key_usage')}, {PAIRS} SELECT constraint_catalog, constraint_schema, constraint_name FROM referential r WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.sc = r.constraint_catalog AND p.fk_schema = r.constraint_schema AND p.fk_name = r.constraint_name)")
def fk_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk.unresolved(fixture(spark, "referential", sf_dir), _pairs(spark, sf_dir)).select("constraint_catalog", "constraint_schema", "constraint_name")


@query(f"WITH {STRIPPED}, {given('constraints')}, {infer_sql('meta', 'constraints')} SELECT * FROM edges e WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('lake.main.orders.custkey', 'lake.main.customer.custkey')) d(s, t) WHERE d.s = e.source_id AND d.t = e.target_id)")
def fk_prior_suppress(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = nodes.columns_frame(snapshot(spark, sf_dir, stripped=True).columns)
    known = spark.createDataFrame([("lake.main.orders.custkey", "lake.main.customer.custkey")], "source_id string, target_id string")
    return fk.infer(frame, fk.pk_gate(frame, fixture(spark, "constraints")), known).drop("criteria")


@query(f"""WITH {given('shop_columns', 'shop_keys', 'referential', 'key_usage')}, {PAIRS}, {infer_sql('shop_columns', 'shop_keys')},
d AS (SELECT lower(concat_ws('.', sc, ss, st, s_c)) AS source_id, lower(concat_ws('.', tc, ts, tt, t_c)) AS target_id, 1.0e0 AS confidence, 'declared' AS source FROM pairs)
SELECT * FROM d UNION ALL SELECT * FROM edges e WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.source_id = e.source_id AND d.target_id = e.target_id)""")
def fk_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk.discover(fixture(spark, "shop_columns", sf_dir), fixture(spark, "shop_keys", sf_dir), _pairs(spark, sf_dir)).drop("criteria")


@query(f"SELECT doc_id, len({TOKENS.format('text')}) AS n_tokens, {TOKENS.format('text')}[1] AS first_token FROM documents")
def comment_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", comment_tokens("text").alias("t"))
    return docs.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.get("t", F.lit(0)).alias("first_token"))


@query(f"WITH {META} SELECT table_name, string_agg(column_name, ',' ORDER BY column_name) AS columns FROM meta WHERE data_type IN ('STRING', 'BOOLEAN') GROUP BY table_name")
def sampleable_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-02, AGG-03."""
    return values.sampleable(snapshot(spark, sf_dir).columns).select("table_name", F.array_join("columns", ",").alias("columns"))


@query(f"WITH {META} SELECT lower(table_catalog || '.' || table_schema || '.' || table_name || '.' || column_name) AS id, table_name IN ('orders', 'lineitem') AS chosen FROM meta")
def scoped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-06, FLT-07: ids below a catalog, of which one has a name that another's begins with, and those of chosen schemas."""
    ids = nodes.column_nodes(snapshot(spark, sf_dir).columns).select("id", "table")
    far = ids.select(F.concat(F.lit("lake_two"), F.substr("id", F.lit(5))).alias("id"), "table")
    moved = ids.unionByName(far).where(in_catalogs("id", ["Lake"])).withColumn("as_schema", F.concat_ws(".", F.lit("lake"), "table", F.lit("x")))
    return moved.select("id", in_schemas("as_schema", ["Orders", "LINEITEM"]).alias("chosen")).where(in_schemas("id", []))


@query(f"WITH {given('schema_names', 'schemas_chosen')} SELECT question_id, coalesce(name, chosen) AS \"schema\" FROM schemas_chosen LEFT JOIN schema_names ON lower(name) = lower(chosen)")
def true_schema_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-13."""
    return retrieve.true_schema_names(fixture(spark, "schemas_chosen", sf_dir).withColumnRenamed("chosen", "schema"), fixture(spark, "schema_names", sf_dir))
