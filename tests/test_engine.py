"""Operators on hand-made frames, plans where their shape matters, and every query against its SQL."""

import glob
import itertools
import json
import os
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from semgraph import schemas as S
from semgraph.config import IngestSettings
from semgraph.functions import text as X
from semgraph.functions.ids import catalog_of, dotted_id, in_catalogs, schema_of
from semgraph.functions.types import LAKE_TYPES, canonical_type, coerce_type
from semgraph.operators import blueprint, embed, fk, grade, nodes, questions, retrieve, store, values
from semgraph.operators.running import running_total
from semgraph.oracles import oracle_sql
from semgraph.plans import answer, ingest, materialize
from semgraph.queries import queries
from semgraph.registry import fixture
from semgraph.sources import metadata
from semgraph.streaming.ledger import embed_stream

SF = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def canonical(df):
    names = sorted(df.columns)
    return sorted(map(str, df[names].astype(object).where(df[names].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got, want = queries()[name](spark, SF).toPandas(), duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() == 8
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_approximate_cardinality_is_close(spark):
    exact = {r["col_name"]: r["card"] for r in values.cardinalities(spark.read.parquet(f"{SF}/lineitem.parquet"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"], exact=True).collect()}
    got = {r["col_name"]: r["card"] for r in queries()["card_approx"](spark, SF).collect()}
    assert all(abs(got[c] - n) <= max(1, 0.15 * n) for c, n in exact.items())


def test_ids(spark):
    assert one(spark, dotted_id(F.lit("A"), F.lit(None), F.lit("B-c d"))) == "a.b-c d"
    assert one(spark, schema_of(F.lit("a.b.c"))) == "b" and one(spark, schema_of(F.lit("a.b"))) is None
    assert one(spark, catalog_of(F.lit("a.b.c.d"))) == "a"
    assert one(spark, in_catalogs(F.lit("ab.c"), ["a"])) is False and one(spark, in_catalogs(F.lit("a.c"), ["A"])) is True


def test_types(spark):
    assert one(spark, canonical_type(F.lit("numeric(9,3)"))) == "DECIMAL|3"
    for raw, lake in LAKE_TYPES.items():
        assert one(spark, coerce_type(F.lit(raw.lower()))).asDict() == {"lake_type": lake, "fallback": False}


@pytest.mark.parametrize(
    "script, want",
    [
        ("SELECT 1; SELECT 2;", ["SELECT 1", "SELECT 2"]),
        ("INSERT INTO t VALUES ('a;b', 'it''s') -- no; end\n; -- only a remark\n;", ["INSERT INTO t VALUES ('a;b', 'it''s') -- no; end"]),
        ("select a-b from t", ["select a-b from t"]),
        ("", []),
    ],
)
def test_statements_of_a_script(script, want):
    assert X.split_statements(script) == want


def test_names():
    assert X.quoted_name("a.b_c", 2) == "`a`.`b_c`"
    for bad in ("1a", "a`b", "", "a b"):
        with pytest.raises(ValueError):
            X.validate_identifier(bad)
    assert X.response_key("e", "a", ["p", "q"]) != X.response_key("e", "a", ["q", "p"])


def test_candidates_are_an_equi_join(spark):
    plan = fk.candidates(nodes.columns_frame(fixture(spark, "shop_columns")))._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "Generate" in physical and "Window" in physical and "CartesianProduct" not in physical and "NestedLoop" not in physical


def test_many_tables_give_few_candidates(spark):
    columns = spark.range(80).select(
        F.lit("c").alias("table_catalog"), F.lit("s").alias("table_schema"), F.concat(F.lit("t"), "id").alias("table_name"),
        F.explode(F.array(F.lit("id"), F.concat(F.lit("t"), ((F.col("id") + 1) % 80).cast("string"), F.lit("_id")), F.concat(F.lit("v"), "id"))).alias("column_name"),
    ).withColumns({"data_type": F.lit("BIGINT"), "is_nullable": F.lit("YES"), "ordinal_position": F.lit(1), "comment": F.lit(None).cast("string")})
    frame = nodes.columns_frame(columns)
    n = frame.count()
    assert 80 <= fk.candidates(frame).count() < 0.05 * n * n
    assert fk.infer(frame, fk.pk_gate(frame, spark.createDataFrame([], S.CONSTRAINTS)), threshold=0.7).count() == 80


def test_names_that_all_tables_share_make_no_pairs(spark):
    """2,000 tables with a created_at each: all its pairs would be four million."""
    columns = spark.range(2000).select(
        F.lit("c").alias("table_catalog"), F.lit("s").alias("table_schema"), F.concat(F.lit("t"), "id").alias("table_name"),
        F.explode(F.array(F.lit("id"), F.concat(F.lit("t"), ((F.col("id") + 1) % 2000).cast("string"), F.lit("_id")), F.lit("created_at"))).alias("column_name"),
    ).withColumns({"data_type": F.lit("BIGINT"), "is_nullable": F.lit("YES"), "ordinal_position": F.lit(1), "comment": F.lit(None).cast("string")})
    frame = nodes.columns_frame(columns)
    gate = fk.pk_gate(frame, spark.createDataFrame([], S.CONSTRAINTS))
    assert fk.candidates(frame, gate).count() < 3 * 2000
    assert fk.infer(frame, gate, threshold=0.7).count() == 2000


def test_ids_of_many_tables_do_not_meet(spark):
    """40,000 tables with an id each: its pairs would be 1.6 thousand million, which take minutes; each reference is found."""
    columns = spark.range(40_000).select(
        F.lit("c").alias("table_catalog"), F.lit("s").alias("table_schema"), F.concat(F.lit("t"), "id").alias("table_name"),
        F.explode(F.when(F.col("id") % 2 == 0, F.array(F.lit("id"))).otherwise(F.array(F.lit("id"), F.concat(F.lit("t"), (F.col("id") - 1).cast("string"), F.lit("_id"))))).alias("column_name"),
    ).withColumns({"data_type": F.lit("BIGINT"), "is_nullable": F.lit("YES"), "ordinal_position": F.lit(1), "comment": F.lit("serial number")})
    frame = nodes.columns_frame(columns)
    began = time.monotonic()
    assert fk.infer(frame, fk.pk_gate(frame, spark.createDataFrame([], S.CONSTRAINTS))).count() == 20_000
    assert time.monotonic() - began < 45


def test_keys_that_many_tables_share_leave_few_rows(spark):
    """600 tables refer to a name that is a key in 300 of them, and four to one of two keys; no step makes the 180,000 pairs of the first."""
    rows = [("c", "s", f"t{i}", "many", "INT") for i in range(600)] + [("c", "s", f"u{i}", "few", "INT") for i in range(4)] + [("c", "s", "u0", "many_id", "INT"), ("c", "s", "Many", "id", "INT"), ("c", "s", "U1", "FEW", "INT"), ("c", "s", "v", "few", "STRING")]
    columns = spark.createDataFrame([(*r, "YES", 1, None) for r in rows], "table_catalog string, table_schema string, table_name string, column_name string, data_type string, is_nullable string, ordinal_position int, comment string")
    keys = spark.createDataFrame([("c", "s", t, c, "PRIMARY KEY", 1, f"pk_{t}") for t, c in [*((f"t{i}", "many") for i in range(300)), ("u0", "few"), ("u1", "few")]], "table_catalog string, table_schema string, table_name string, column_name string, constraint_type string, ordinal_position int, constraint_name string")
    frame = nodes.columns_frame(columns)
    for gate in (fk.pk_gate(frame, keys), fk.pk_gate(frame, keys, whole=True)):
        found = fk.infer(frame, gate)
        want = {("c.s.u2.few", "c.s.u0.few"), ("c.s.u2.few", "c.s.u1.few"), ("c.s.u3.few", "c.s.u0.few"), ("c.s.u3.few", "c.s.u1.few"), ("c.s.u0.few", "c.s.u1.few"), ("c.s.u1.few", "c.s.u0.few")}
        assert sorted((r["source_id"], r["target_id"]) for r in found.collect()) == sorted(want)
    rows = found._jdf.queryExecution().executedPlan()
    assert "rank" in rows.toString().lower() and fk.candidates(frame, fk.pk_gate(frame, keys)).count() > 170_000


def test_inference_makes_its_rows_in_compiled_code(spark):
    """Keys, scores and tokens came from lambdas, which Spark interprets row by row; types and tokens stay what they were."""
    frame = nodes.columns_frame(fixture(spark, "shop_columns"))
    plan = fk.infer(frame, fk.pk_gate(frame, fixture(spark, "shop_keys"), whole=True))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    texts = ["Columns of column and TABLE columnar", "the table_id stable tabled", "", None, "a1b2 x9 tablecolumn column", "name-table", "tab column9 9table"]
    got = [r["t"] for r in spark.createDataFrame(list(enumerate(texts)), "i int, c string").orderBy("i").select(X.comment_tokens("c").alias("t")).collect()]
    assert got == [[w for w in "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in (t or "").lower()).split() if len(w) >= 4 and w not in X.COMMENT_STOPWORDS] for t in texts]
    for given, want in {"int": "INTEGER", " char ": "STRING", "char(3)": "STRING", "numeric": "NUMERIC", "decimal(9)": "DECIMAL|0", "decimal(9,3)": "DECIMAL|3", "int(4)": "INT(4)", "array<int>": "ARRAY<INT>", "numeric(": "NUMERIC(", "": ""}.items():
        assert one(spark, canonical_type(F.lit(given))) == want, given


def test_jobs_of_one_inference(spark):
    """One inference over 80 tables with primary keys takes at most sixteen jobs."""
    columns = spark.range(80).select(
        F.lit("c").alias("table_catalog"), F.lit("s").alias("table_schema"), F.concat(F.lit("t"), "id").alias("table_name"),
        F.explode(F.when(F.col("id") > 0, F.array(F.lit("id"), F.lit("name"), F.concat(F.lit("t"), (F.col("id") - 1).cast("string"), F.lit("_id")))).otherwise(F.array(F.lit("id"), F.lit("name")))).alias("column_name"),
    ).withColumns({"data_type": F.lit("BIGINT"), "is_nullable": F.lit("YES"), "ordinal_position": F.lit(1), "comment": F.lit(None).cast("string")})
    keys = columns.where("column_name = 'id'").select("table_catalog", "table_schema", "table_name", "column_name", F.lit("PRIMARY KEY").alias("constraint_type"), F.lit(1).alias("ordinal_position"), F.concat(F.lit("pk_"), "table_name").alias("constraint_name"))
    sc = spark.sparkContext
    sc.setJobGroup("inference", "one action")
    try:
        assert fk.discover(columns, keys).count() == 79
        jobs = len(sc.statusTracker().getJobIdsForGroup("inference"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= 16


def test_fk_limit_skips_inference(spark):
    assert fk.discover(fixture(spark, "shop_columns"), fixture(spark, "shop_keys"), max_columns=3).count() == 0


def test_projection_is_closed(spark):
    df = nodes.table_nodes(spark.createDataFrame([("c", "s", "t", "EXTERNAL", " note ", None, None)], S.TABLES), {"c": "gold"})
    assert df.first()["embedding_text"] == "c.s.t | note" and df.first()["layer"] == "gold"
    assert nodes.project(df, "Table").columns == [c for c in S.NODE_PROPERTIES["Table"] if c != "embedding"]
    with pytest.raises(ValueError):
        nodes.project(df.drop("layer"), "Table")
    with pytest.raises(ValueError):
        nodes.balanced_union([])


def test_top_values_are_limited_within_groups(spark):
    plan = queries()["value_topn"](spark, SF)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_ledger_reuse_and_stream(spark, tmp_path):
    calls = embed.hash_embedding(8)
    texts = spark.createDataFrame([("a", "one two"), ("b", "three"), ("c", None)], "id string, embedding_text string")
    frozen, stats = embed.embedded_batch(texts, "Table", str(tmp_path), calls, 8, "m")
    assert stats.first()["successes"] == 3 and frozen.count() == 3
    changed = texts.where("id <> 'c'").withColumn("embedding_text", F.when(F.col("id") == "b", "other").otherwise(F.col("embedding_text")))
    first = {r["id"]: r["embedded_at"] for r in frozen.collect()}
    second = {r["id"]: r["embedded_at"] for r in embed.embedded_batch(changed, "Table", str(tmp_path), calls, 8, "m")[0].collect()}
    assert second["a"] == first["a"] and second["b"] > first["b"]
    broken = lambda c: F.struct(F.lit(None).cast("array<double>").alias("result"), F.lit("down").alias("errorMessage"))
    with pytest.raises(RuntimeError):
        embed.embedded_batch(texts, "Schema", str(tmp_path), broken, 8, "m", most_failures=1)
    source = tmp_path / "in"
    texts.write.parquet(str(source))
    for _ in range(2):
        embed_stream(spark.readStream.schema(texts.schema).parquet(str(source)), "Column", str(tmp_path), calls, 8, "m").awaitTermination(120)
    assert embed.read_ledger(spark, str(tmp_path / "nothing")) is None
    assert embed.read_pointer(spark, f"{tmp_path}/ledger/column")


def test_ingest_verify_and_retrieve(spark, tmp_path):
    snapshot = metadata.from_directory(spark, SF, rename=metadata.strip_prefix)

    def read(_, __, table):
        df = spark.read.parquet(f"{SF}/{table}.parquet")
        return df.select(*(F.col(c).alias(metadata.strip_prefix(table, c)) for c in df.columns))

    settings = IngestSettings(embed_labels=("Table", "Column"), sample_limit=5)
    report = ingest.ingest(spark, snapshot, read, fixture(spark, "constraints"), str(tmp_path), settings)
    assert report.where("n > 0").count() == 0
    target = store.GraphStore(spark, str(tmp_path))
    graph = ingest.Graph({n: target.read(n) for n in S.NODE_PROPERTIES}, {r: target.read(r) for r in S.REL_TYPES})
    counts = {r["name"]: r["n"] for r in store.counts(graph.nodes | graph.edges).collect()}
    assert (counts["Table"], counts["Column"], counts["REFERENCES"]) == (14, 63, 8) and counts["HAS_VALUE"] == counts["Value"] > 0
    row = ingest.summary(spark, "r1", "ingest", report, store.counts(graph.nodes))
    store.append_summary(row, f"{tmp_path}/summary")
    assert store.latest_summary(spark, f"{tmp_path}/summary", "ingest").first()["verify_ok"] and json.loads(ingest.summary_json(row))["run_id"] == "r1"
    asked = spark.createDataFrame([("q1", "total price of orders by market segment of the customer")], "question_id string, question string")
    asked = asked.withColumn("vector", embed.hash_embedding(64)(F.col("question"))["result"])
    text = answer.GraphRetriever(graph).retrieve(asked).text.first()["text"]
    assert text.startswith("Target schema: main\n\nTables:\nTable: `lake`.`main`.") and "mktsegment" in text


def test_evaluation_grades_answers(spark):
    spark.read.parquet(f"{SF}/orders.parquet").createOrReplaceTempView("orders_eval")
    asked = spark.createDataFrame([("q1", "x", "SELECT count(*) AS n FROM orders_eval"), ("q2", "y", None)], "question_id string, question string, reference_sql string")
    fixed = lambda sql: lambda q: q.select("question_id", F.lit(sql).alias("answer"))
    arms = {"good": fixed("```sql\nSELECT count(*) AS n FROM orders_eval\n```"), "bad": fixed("SELECT 1 AS n"), "broken": fixed("SELECT * FROM nowhere_at_all"), "mute": fixed("sorry")}
    got = {(r["arm"], r["question_id"]): r for r in answer.evaluate(spark, asked, arms).collect()}
    assert got["good", "q1"]["correct"] and got["bad", "q1"]["correct"] is False and got["good", "q2"]["correct"] is None
    assert not got["broken", "q1"]["executed"] and not got["mute", "q1"]["parsed"]
    with pytest.raises(ValueError):
        answer.evaluate(spark, asked, arms, most=1)


def test_only_reading_statements_run_and_references_run_once(spark, monkeypatch):
    spark.read.parquet(f"{SF}/orders.parquet").createOrReplaceTempView("orders_eval")
    reference = "SELECT count(*) AS n FROM orders_eval"
    asked = spark.createDataFrame([("q1", "x", reference), ("q2", "y", "SELECT * FROM nowhere_at_all")], "question_id string, question string, reference_sql string")
    fixed = lambda sql: lambda q: q.select("question_id", F.lit(sql).alias("answer"))
    seen, run = [], answer._run
    monkeypatch.setattr(answer, "_run", lambda s, sql, seconds: seen.append(sql) or run(s, sql, seconds))
    arms = {"a": fixed("SELECT 1500 AS n"), "b": fixed("CREATE TABLE made_by_answer AS SELECT 1 AS x"), "c": fixed("SELECT 1 AS n")}
    got = {(r["arm"], r["question_id"]): r for r in answer.evaluate(spark, asked, arms).collect()}
    assert got["a", "q1"]["correct"] is True and got["c", "q1"]["correct"] is False and got["a", "q2"]["correct"] is False
    assert got["b", "q1"]["parsed"] and not got["b", "q1"]["executed"] and not spark.catalog.tableExists("made_by_answer")
    assert seen.count(reference) == 1
    outside = answer.evaluate(spark, asked, {"a": fixed(reference)}, catalog="lake").collect()
    assert not any(r["executed"] for r in outside)


def test_a_statement_that_takes_too_long_fails(spark):
    long = "SELECT sum(a.id * b.id % 7) AS n FROM range(10000000) a CROSS JOIN range(10000000) b"
    asked = spark.createDataFrame([("q1", "x", "SELECT 1 AS n")], "question_id string, question string, reference_sql string")
    fixed = lambda sql: lambda q: q.select("question_id", F.lit(sql).alias("answer"))
    got = {r["arm"]: r for r in answer.evaluate(spark, asked, {"long": fixed(long), "short": fixed("SELECT 1 AS n")}, seconds=3).collect()}
    assert not got["long"]["executed"] and got["short"]["correct"]


def test_answers_are_kept_by_their_prompts(spark, tmp_path):
    calls = []

    def generate(q):
        calls.append(1)
        return q.select("question_id", F.upper("prompt").alias("answer"))

    first = spark.createDataFrame([("1", "a"), ("2", "b")], "question_id string, prompt string")
    ask = lambda q, arm: sorted(map(tuple, answer.cached_answers(q, "e", arm, generate, str(tmp_path)).collect()))
    assert ask(first, "x") == ask(first.orderBy(F.desc("question_id")), "x") == [("1", "A"), ("2", "B")] and len(calls) == 1
    ask(first, "y")
    ask(first.where("question_id = '1'"), "x")
    assert len(calls) == 3


def test_questions_are_embedded_all_or_none():
    asked = []

    def send(some):
        asked.append(len(some))
        return [{"index": i, "embedding": [float(t)]} for i, t in reversed(list(enumerate(some)))]

    assert answer.embed_questions([str(i) for i in range(250)], send) == [[float(i)] for i in range(250)] and asked == [100, 100, 50]
    for wrong in (lambda s: send(s)[1:], lambda s: [{"index": 0, "embedding": [0.0] * (1 + int(s[0]))}] if len(s) == 1 else send(s)):
        with pytest.raises(ValueError):
            answer.embed_questions(["0", "1", "2"], wrong, size=2) if wrong(["0"]) == [] else answer.embed_questions(["1", "0"], wrong, size=1)
    assert answer.embed_questions([], send) == []


def test_an_empty_graph_is_refused(spark):
    with pytest.raises(ValueError):
        answer.assert_populated(ingest.Graph({"Table": spark.createDataFrame([], "id string")}, {}))
    answer.assert_populated(ingest.Graph({"Table": spark.createDataFrame([("a",)], "id string")}, {}))


def test_keys_of_materialized_tables(spark, tmp_path):
    table_ = lambda name, columns, key, fks, rows: {"name": name, "columns": [{"name": c, "type": t} for c, t in columns], "primary_key": key, "foreign_keys": fks, "rows": rows}
    users = table_("Users", [("id", "int"), ("v", "text")], ["id"], [], [["1", "a"], ["2", "it's"]])
    orders = table_("Orders", [("id", "int"), ("user id", "int")], ["id"], [{"columns": ["user id"], "foreign_table": "Users", "referred_columns": ["id"]}], [[None, "1"]])
    empty = table_("Empty", [("id", "int")], [], [], [])
    (tmp_path / "b.json").write_text(json.dumps({"schemas": [{"source_id": "x", "uc_schema": "s", "tables": [users, orders, empty]}]}))
    tables = blueprint.read_blueprint(spark, str(tmp_path / "b.json"))
    done = {r["table"]: (r["n_rows"], r["error"]) for r in materialize.materialize(spark, tables, str(tmp_path / "out")).collect()}
    assert done == {"users": (2, None), "orders": (1, None), "empty": (0, None)}
    keys = {(r["table"], r["kind"], tuple(r["columns"]), r["parent"]) for r in spark.read.parquet(str(tmp_path / "out/_keys")).collect()}
    assert keys == {("users", "PRIMARY KEY", ("id",), None), ("orders", "FOREIGN KEY", ("user_id",), "users")}
    assert not [p for p in os.listdir(tmp_path / "out") if p.startswith("_staged")]
    inserts = {r["table"]: r["ddl"] for r in blueprint.insert_statements(tables, blueprint.planned_columns(tables), "c").collect()}
    assert inserts["users"] == "INSERT OVERWRITE `c`.`s`.`users` (`id`, `v`) VALUES (CAST('1' AS INT), 'a'), (CAST('2' AS INT), 'it''s')" and "empty" not in inserts
    properties = {r["table"]: r["properties"] for r in blueprint.table_properties(tables, "p").collect()}
    assert json.loads(properties["orders"]["p.foreign_keys"]) == [{"columns": ["user id"], "foreign_table": "Users", "referred_columns": ["id"]}] and properties["users"]["p.primary_keys"] == '["id"]'


def test_values_are_sampled_in_batches(spark, tmp_path):
    columns = spark.createDataFrame([("c", "s", f"t{i}", "v", "STRING", "YES", 1, None) for i in range(5)], S.COLUMNS)
    tables = spark.createDataFrame([("c", "s", f"t{i}", "BASE", None, None, None) for i in range(5)], S.TABLES)
    snapshot = metadata.Snapshot(spark.createDataFrame([("c", "s", None)], S.SCHEMATA), tables, columns)
    read = lambda c, s, t: spark.range(6).select((F.col("id") % 2).cast("string").alias("v"))
    got = ingest.sample(snapshot, read, IngestSettings(catalogs=("c",), tables_per_batch=2), str(tmp_path / "x"))
    assert sorted((r["tbl_name"], r["val"], r["cnt"]) for r in got.collect()) == [(f"t{i}", v, 3) for i in range(5) for v in "01"]


def test_grading_of_large_results(spark):
    n = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    assert grade.compare(n.where("id < 950"), n)[0] is False or grade.compare(n.where("id < 950"), n)[1] is None
    assert "divergence" in grade.compare(n.where("id < 800"), n)[1]
    assert grade.compare(n, n.where("id < 990")) == (True, None)
    assert grade.compare(n.limit(0), n.limit(0)) == (True, None)


def test_blueprint_files(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"schemas": [{"source_id": "x", "uc_schema": "s", "tables": [{"name": "T 1", "columns": [{"name": "id", "type": "int"}, {"name": "v", "type": "VARCHAR(9)"}], "primary_key": ["id"], "foreign_keys": [], "rows": [["1", "a"], ["2", None]]}]}]}))
    done = materialize.materialize(spark, blueprint.read_blueprint(spark, str(tmp_path / "b.json")), str(tmp_path / "out"))
    assert done.first().asDict() == {"schema": "s", "table": "t_1", "n_rows": 2, "n_columns": 2, "fallbacks": 0, "error": None}
    assert materialize.totals(done).first()["rows_inserted"] == 2
    assert dict(spark.read.parquet(str(tmp_path / "out/s/t_1")).dtypes) == {"id": "int", "v": "string"}
    (tmp_path / "s.json").write_text(json.dumps({"my db.sql": {"TABLES": {"a": {"COLUMNS": {"x": {"TYPE": "Int", "VALUES": ["1", "2"]}, "y": {"TYPE": "Text", "VALUES": ["p", "q"]}}, "PRIMARY_KEYS": ["x"], "FOREIGN_KEYS": []}}}}))
    row = blueprint.read_slice(spark, str(tmp_path / "s.json")).first()
    assert row["schema"] == "sp_my_db" and row["rows"] == [["1", "p"], ["2", "q"]]


def test_question_files(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps([{"question_id": "1", "question": "a", "notes": " "}]))
    assert questions.read_questions(spark, str(tmp_path / "q.json")).first()["notes"] is None
    (tmp_path / "q2.json").write_text(json.dumps([{"question_id": "", "question": "a"}]))
    with pytest.raises(ValueError):
        questions.read_questions(spark, str(tmp_path / "q2.json"))
    (tmp_path / "batch_1.json").write_text(json.dumps([{"question_id": "1", "sql": "SELECT 1"}]))
    (tmp_path / "batch_2.json").write_text("{broken")
    assert questions.read_batches(spark, str(tmp_path)).count() == 1


def test_readable_schemas(spark):
    good, bad = lambda: spark.range(1), lambda: spark.read.parquet("/nowhere/at/all")
    assert metadata.readable_schemas({"a": [bad, good], "b": [bad, bad, bad, good], "c": []}) == ["a", "c"]


def test_tables_of_the_session(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_of_tests")
    try:
        spark.sql("CREATE TABLE shop_of_tests.bolts (id BIGINT, name STRING COMMENT 'what it is') USING parquet")
        found = metadata.from_session(spark, ["shop_of_tests"])
        assert [(r["table_schema"], r["table_name"]) for r in found.tables.collect()] == [("shop_of_tests", "bolts")]
        assert [(r["column_name"], r["data_type"], r["comment"]) for r in found.columns.orderBy("ordinal_position").collect()] == [("id", "BIGINT", None), ("name", "STRING", "what it is")]
        assert [r["schema_name"] for r in found.schemata.collect()] == ["shop_of_tests"]
        assert not {"information_schema"} & {r["schema_name"] for r in metadata.from_session(spark).schemata.collect()}
    finally:
        spark.sql("DROP DATABASE shop_of_tests CASCADE")


def test_cosine_of_itself(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")).where("id < 20")
    got = retrieve.cosine_topk(v.select(F.col("id").alias("question_id"), "vector"), v, 1).collect()
    assert all(r["id"] == r["question_id"] and r["score"] >= 0.99 for r in got)


def test_vector_searches_ask_and_answer_over_all_ids(spark):
    vectors = {r["vec_id"]: r["label"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label").collect()}
    asking = {i for i in vectors if i % 100 == 0}
    got = queries()["cosine_topk"](spark, SF).collect()
    assert {r["question_id"] for r in got} == asking and len(got) == 5 * len(asking) and all(r["question_id"] != r["id"] for r in got)
    pairs = {(r["question_id"], r["id"]) for r in queries()["cosine_candidates"](spark, SF).collect()}
    assert pairs == {(q, i) for q in asking for i in vectors if q != i and vectors[q] == vectors[i]} | {(q, -1) for q in asking}
    for name in ("vector_prefilter_topk", "select_schema"):
        assert {r["question_id"] for r in queries()[name](spark, SF).select("question_id").collect()} == asking


def test_every_benchmark_passage_is_searched(spark):
    passages = {r["item_id"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id").collect()}
    assert len(passages) > 10
    for name in ("fulltext_topk", "hybrid_topk"):
        assert {r["question_id"] for r in queries()[name](spark, SF).select("question_id").collect()} == passages


def test_running_totals_equal_a_plain_sum(spark):
    rng = random.Random(3)
    keys = sorted({rng.randrange(10**6) for _ in range(500)})
    made = [(None, 7)] + [(k, rng.randrange(9)) for k in keys]
    for name, frame in (("long", spark.createDataFrame(made, "k long, n long")), ("text", spark.createDataFrame([(None if k is None else f"{k:07d}", n) for k, n in made], "k string, n long")), ("list", spark.createDataFrame([(None if k is None else [f"{k:07d}", "x"], n) for k, n in made], "k array<string>, n long"))):
        got = [r["upto"] for r in running_total(frame.repartition(5), "k", "n").orderBy(F.col("k").asc_nulls_first()).collect()]
        assert got == list(itertools.accumulate(n for _, n in made)), name
    assert running_total(spark.createDataFrame([], "k long, n long"), "k", "n").count() == 0


def test_words_inside_names(spark):
    asked = spark.createDataFrame([(1, "steel bolts and art"), (2, "of to"), (3, None)], "question_id int, question string")
    names = spark.createDataFrame([("a", "BOLTS"), ("b", "cart"), ("c", "ar"), ("d", None), ("e", "steelworks"), ("f", "bolt")], "id string, name string")
    assert {(r[0], r[1]) for r in retrieve.lexical_tables(asked, names).collect()} == {(1, "a"), (1, "b"), (1, "e")}


def test_whole_texts_pass_through_the_literal_rule(spark):
    texts = {(r["conv_id"], r["turn"]): r["text"] for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    got = {(r["conv_id"], r["turn"]): r["literal"] for r in queries()["sql_literals"](spark, SF).collect()}
    assert any(len(t or "") > 30 for t in texts.values())
    assert got == {k: "NULL" if t is None else "'" + t.replace("\\", "\\\\").replace("'", "''") + "'" for k, t in texts.items()}


def test_settings_are_checked():
    for wrong in ({"fk_threshold": 2}, {"sample_limit": 0}, {"catalogs": ()}, {"fk_max_columns": -1}):
        with pytest.raises(ValueError):
            IngestSettings(**wrong)
