"""Queries that run whole plans over the given tables: ingest, evaluation, materializing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import IngestSettings
from ..operators import blueprint, embed, grade, store
from ..registry import fixture, given, query, table
from ..sources import metadata
from ..sources.shared import own_folder
from . import answer, ingest, materialize
from .queries_catalog import NAMES, STRIPPED, infer_sql
from .queries_data import PLANNED, blueprints, counts_sql

#: The columns of text, from which an ingest samples values.
TEXTS = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"], "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"], "documents": ["text", "lang", "source"], "pages": ["url", "html"], "benchmark": ["text"], "conversations": ["role", "text"],
}


@query(f"""WITH {STRIPPED}, {given('constraints')}, {infer_sql('meta', 'constraints')}, counts AS ({counts_sql(TEXTS)}), kept AS (SELECT least(count(*), 10) AS n FROM counts GROUP BY tbl_name, col_name HAVING count(*) < 50),
v AS (SELECT coalesce(sum(n), 0)::BIGINT AS n FROM kept), t AS (SELECT count(DISTINCT table_name) AS n FROM meta), c AS (SELECT count(*) AS n FROM meta)
SELECT 'Database' AS name, 1::BIGINT AS n UNION ALL SELECT 'Schema', 1 UNION ALL SELECT 'HAS_SCHEMA', 1 UNION ALL SELECT 'violations', 0 UNION ALL SELECT 'Value', n FROM v UNION ALL SELECT 'HAS_VALUE', n FROM v
UNION ALL SELECT x, n FROM t, (VALUES ('Table'), ('HAS_TABLE'), ('embedded Table')) k(x) UNION ALL SELECT x, n FROM c, (VALUES ('Column'), ('HAS_COLUMN'), ('embedded Column')) k(x) UNION ALL SELECT 'REFERENCES', count(*) FROM edges""")
def ingest_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-EXTRACT, OP-VALUES, OP-EMB, OP-LOAD, OP-PREFLIGHT, SNK-05, SRC-14: the given tables become a graph; its counts come from the summary of the run, kept and read again."""
    folder, every = own_folder(spark, "graph"), metadata.from_directory(spark, sf_dir, rename=metadata.strip_prefix)
    snapshot = metadata.Snapshot(every.schemata, *(df.where(F.col("table_name").isin(*NAMES)) for df in (every.tables, every.columns)))

    def read(_: str, __: str, name: str) -> DataFrame:
        df = table(spark, sf_dir, name)
        return df.select(*(F.col(c).alias(metadata.strip_prefix(name, c)) for c in df.columns))

    report = ingest.ingest(spark, snapshot, read, fixture(spark, "constraints"), folder, IngestSettings(embed_labels=("Table", "Column"), exact_cardinality=True))
    kept = store.GraphStore(spark, folder)
    found = store.counts({name: kept.read(name) for name in (*S.NODE_PROPERTIES, *S.REL_TYPES)})
    store.append_summary(ingest.summary(spark, "r1", "ingest", report, found), f"{folder}/summary")
    run = store.latest_summary(spark, f"{folder}/summary", "ingest")
    ledgers = store.counts({f"embedded {label}": embed.current_ledger(spark, folder, label)[0] for label in ("Table", "Column")})
    return run.select(F.explode("row_counts").alias("name", "n")).unionByName(run.select(F.lit("violations").alias("name"), F.size("violations").cast("long").alias("n"))).unionByName(ledgers)


ARMS = "same", "wider", "unsafe", "mute"


@query("""WITH n AS (SELECT n_regionkey AS r, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1),
a AS (SELECT arm, r_regionkey AS r, arm IN ('same', 'wider') AS runs, arm <> 'mute' AS parsed FROM region, (VALUES ('same'), ('wider'), ('unsafe'), ('mute')) k(arm)),
g AS (SELECT arm, parsed, runs, runs AND EXISTS (SELECT 1 FROM n WHERE n.r = a.r OR (arm = 'wider' AND n.r < a.r)) AS non_empty, CASE WHEN runs THEN arm = 'same' OR NOT EXISTS (SELECT 1 FROM n WHERE n.r < a.r) END AS correct FROM a)
SELECT arm, count(*) AS attempted, count(*) FILTER (parsed) AS parsed, count(*) FILTER (runs) AS executed, count(*) FILTER (non_empty) AS non_empty, count(*) FILTER (correct) AS correct, count(correct) AS gradable,
  round(count(*) FILTER (parsed) / count(*), 3) AS parse_rate, round(count(*) FILTER (runs) / count(*), 3) AS execution_rate, round(count(*) FILTER (non_empty) / greatest(count(*) FILTER (runs), 1), 3) AS non_empty_rate, round(count(*) FILTER (correct) / greatest(count(correct), 1), 3) AS correct_rate FROM g GROUP BY arm""")
def evaluated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-EVAL, SRC-15, SNK-12, AGG-16: of each region the customers of its nations are asked for; one arm answers so, one takes the regions before it too, one would change a table, one gives no SQL."""
    for name in ("nation", "customer"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"{name}_given")
    key = F.col("r_regionkey").cast("string")
    wanted = lambda op: F.concat(F.lit(f"SELECT n_name, count(*) AS n FROM nation_given JOIN customer_given ON c_nationkey = n_nationkey WHERE n_regionkey {op} "), F.col("question_id"), F.lit(" GROUP BY n_name"))
    asked = table(spark, sf_dir, "region").select(key.alias("question_id"), F.concat(F.lit("Customers of each nation of "), F.col("r_name")).alias("question")).withColumn("reference_sql", wanted("="))
    texts = dict(zip(ARMS, (F.concat(F.lit("```sql\n"), wanted("="), F.lit("\n```")), wanted("<="), F.concat(F.lit("DELETE FROM nation_given WHERE n_regionkey = "), F.col("question_id")), F.lit("I cannot answer")), strict=True))
    kept = own_folder(spark, "answers")
    prompted = lambda q: q.withColumn("prompt", F.col("question"))
    arms = {a: lambda q, a=a, text=text: answer.cached_answers(prompted(q), "endpoint", a, lambda p: p.withColumn("answer", text), kept) for a, text in texts.items()}
    return grade.arm_summary(answer.evaluate(spark, asked, arms))


@query("""WITH p AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part), t AS (SELECT 'parts' AS "schema", lower(replace(p_brand, '#', '_')) AS "table", least(max(n), 20)::BIGINT AS n_rows, 4 AS n_columns, 1 AS fallbacks FROM p GROUP BY p_brand)
SELECT "schema", "table", n_rows, n_columns, fallbacks, NULL::VARCHAR AS error FROM t UNION ALL SELECT '*', count(*) || ' tables', sum(n_rows)::BIGINT, 0, sum(fallbacks)::INTEGER, NULL FROM t""")
def materialized_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-MATERIALIZE, SRC-12, AGG-19: a blueprint file with a table for each brand, its first twenty parts as sample rows, becomes tables; their sums beside them."""
    part = table(spark, sf_dir, "part")
    cells = F.array(*(F.col(c).cast("string") for c in ("p_partkey", "p_name", "p_size", "p_retailprice")))
    # The first twenty of each brand: a bounded number of rows a table.
    first = part.withColumn("n", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))).where("n <= 20").groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", cells.alias("r")))), lambda x: x["r"]).alias("rows"))
    shape = blueprint.BLUEPRINT.removeprefix("schemas ")
    columns = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(None).cast("string").alias("comment")) for n, t in (("Part Key", "bigint"), ("Name", "varchar(55)"), ("Size", "int"), ("Price", "geometry"))))
    keys = F.array().cast("array<struct<columns array<string>, foreign_table string, referred_columns array<string>>>")
    one = first.select(F.struct(F.col("p_brand").alias("name"), columns.alias("columns"), F.array(F.lit("Part Key")).alias("primary_key"), keys.alias("foreign_keys"), "rows").alias("t"))
    whole = one.agg(F.array(F.struct(F.lit("part").alias("source_id"), F.lit("parts").alias("uc_schema"), F.collect_list("t").alias("tables"))).cast(shape).alias("schemas"))
    file, out = own_folder(spark, "blueprint"), own_folder(spark, "made")
    whole.coalesce(1).write.json(file)
    done = materialize.materialize(spark, blueprint.read_blueprint(spark, file), out)
    sums = materialize.totals(done).select(F.lit("*").alias("schema"), F.concat(F.col("tables_created").cast("string"), F.lit(" tables")).alias("table"), F.col("rows_inserted").alias("n_rows"), F.lit(0).alias("n_columns"), F.col("type_fallbacks").cast("int").alias("fallbacks"), F.lit(None).cast("string").alias("error"))
    return done.unionByName(sums)


@query(f"""WITH {PLANNED}, raw_columns AS (SELECT t, max(CASE p WHEN 0 THEN c END) AS a, max(CASE p WHEN 1 THEN c END) AS b FROM plan_columns WHERE s = 'parts' GROUP BY t)
SELECT lower(replace(replace(t, '#', '_'), ' ', '_')) AS "table", t AS original_name, '["' || a || '"]' AS primary_keys, '[{{"columns":["' || a || '"],"foreign_table":"' || t || '","referred_columns":["' || coalesce(b, 'gone') || '"]}}]' AS foreign_keys FROM raw_columns""")
def table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN-01: where the tables made from parts come from, and their keys as JSON."""
    p = blueprint.table_properties(blueprints(spark, sf_dir).where("schema = 'parts'").withColumn("source_id", F.col("schema")), "p")
    return p.select("table", *(F.col("properties")[f"p.{k}"].alias(k) for k in ("original_name", "primary_keys", "foreign_keys")))
