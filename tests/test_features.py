"""The statement guard, the clustered store, full-text search and the vector index against plain versions."""

import math
import os
import random
import threading
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from semgraph.operators import clustered, fulltext, guard, store, vectorindex
from semgraph.plans import answer

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("sql", "catalog", "allowed"),
    [
        ("SELECT * FROM `shop`.`sp`.`orders` o JOIN `shop`.`sp`.`customers` c ON o.customer_id = c.id", "shop", True),
        ("SELECT * FROM orders", "cat", False),
        ("SELECT * FROM `other`.`sp`.`orders`", "shop", False),
        ("SELECT * FROM `cat`.`s`.`t`; DROP TABLE `cat`.`s`.`t`", "cat", False),
        ("DELETE FROM `cat`.`s`.`t`", "cat", False),
        ("SELECT * FROM `cat`.`s`.`t` UNION SELECT 1; DROP TABLE x", "cat", False),
        ("SELECT * FROM `cat`.information_schema.tables", "cat", False),
        ("SELECT * FROM system.information_schema.tables", "system", False),
        ("SELECT * FROM lake.a.b, other.x.y", "lake", False),
        ("SELECT * FROM lake.a.b a, parquet.`/etc/x` p", "lake", False),
        ("SELECT * FROM/**/other.x.y", "lake", False),
        ("SELECT * FROM lake.a.b WHERE EXISTS (TABLE other.x.y)", "lake", False),
        ("SELECT 'please update; now' AS s FROM lake.a.b -- drop it", "lake", True),
        ("SELECT `update` FROM LAKE.a.b;", "lake", True),
        ("SELECT update FROM lake.a.b", "lake", False),
        ("SELECT (SELECT max(x) FROM other.x.y) FROM lake.a.b", "lake", False),
        ("SELECT x FROM lake.a.b LIMIT 3 OFFSET 1", "lake", True),
        ("SELECT x, count(*) FROM lake.a.b WHERE x IN (SELECT y FROM lake.a.c) GROUP BY ROLLUP(x) HAVING count(*) > 1 ORDER BY x", "lake", True),
        ("SELECT sum(x) OVER w FROM lake.a.b TABLESAMPLE (10 PERCENT) WINDOW w AS (PARTITION BY y)", "lake", True),
        ("SELECT * FROM lake.a.b, LATERAL (SELECT max(c) FROM lake.a.c) LATERAL VIEW explode(z) t AS y", "lake", True),
        ("SELECT * FROM (SELECT * FROM lake.a.b) PIVOT (sum(x) FOR y IN (1, 2))", "lake", True),
        ("SELECT * FROM range(5) UNION ALL VALUES (1)", "lake", True),
        ("SELECT * FROM read_files('/etc')", "lake", False),
        ("SELECT java_method('java.lang.System', 'exit', 1) FROM lake.a.b", "lake", False),
        ("SELECT upper(reflect('java.lang.System', 'exit', 1)) FROM lake.a.b", "lake", False),
        ("SELECT TRANSFORM (x) USING 'cat' FROM lake.a.b", "lake", False),
        ("SELECT * FROM IDENTIFIER('other.x.y')", "lake", False),
        ("WITH q AS (SELECT 1) SELECT * FROM q", "lake", False),
        ("WITH q AS (SELECT 1 AS a), r AS (SELECT * FROM q) SELECT * FROM r WHERE a IN (SELECT a FROM q)", None, True),
        ("WITH q AS (SELECT * FROM parquet.`/etc/x`) SELECT * FROM q", None, False),
        ("SELECT * FROM parquet.`/etc/x`", None, False),
        ("INSERT INTO t SELECT 1", None, False),
        ("FROM t INSERT INTO u SELECT *", None, False),
        ("EXPLAIN SELECT 1", None, False),
        ("SELECT 1 +", None, False),
        ("", None, False),
        (None, "lake", False),
    ],
)
def test_which_statements_may_run(spark, sql, catalog, allowed):
    assert guard.judge(spark, sql, catalog).allowed is allowed


def test_views_are_looked_into(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    spark.sql("CREATE DATABASE IF NOT EXISTS guarded")
    spark.sql("CREATE TABLE IF NOT EXISTS guarded.t USING parquet AS SELECT 1 AS x")
    spark.sql("CREATE OR REPLACE VIEW guarded.good AS SELECT * FROM guarded.t")
    spark.sql(f"CREATE OR REPLACE VIEW guarded.bad AS SELECT * FROM parquet.`{tmp_path}/t`")
    asked = spark.createDataFrame([("q1", "x", None)], "question_id string, question string, reference_sql string")
    ran = {}
    for name in ("t", "good", "bad"):
        sql = f"SELECT * FROM spark_catalog.guarded.{name} WHERE 1 IN (SELECT x FROM spark_catalog.guarded.t)"
        assert guard.judge(spark, sql, "spark_catalog").allowed
        ran[name] = answer.evaluate(spark, asked, {"a": lambda q, sql=sql: q.select("question_id", F.lit(sql).alias("answer"))}, catalog="spark_catalog").first()["executed"]
    assert ran == {"t": True, "good": True, "bad": False}
    assert guard.reads_from(spark.sql("SELECT * FROM guarded.bad"), "spark_catalog") == ["files"]


def test_statements_overlap_and_one_is_cancelled_alone(spark, monkeypatch):
    slow = "SELECT sum(a.id * b.id % 7) AS n FROM range(0, 10000000, 1, 1) a CROSS JOIN range(0, 10000000, 1, 1) b"  # one task, so others find cores
    answers = [slow] + [f"SELECT count(*) + {i} AS n FROM range(300000) WHERE pow(id, 2) >= 0" for i in range(7)]
    asked = spark.createDataFrame([(f"q{i}", "x", s if i else None) for i, s in enumerate(answers)], "question_id string, question string, reference_sql string")
    texts = spark.createDataFrame([(f"q{i}", s) for i, s in enumerate(answers)], "question_id string, answer string")
    run, at, most, lock = answer._run, [0], [0], threading.Lock()

    def watched(s, sql, seconds):
        with lock:
            at[0] += 1
            most[0] = max(most[0], at[0])
        try:
            time.sleep(0.2)
            return run(s, sql, seconds)
        finally:
            with lock:
                at[0] -= 1

    monkeypatch.setattr(answer, "_run", watched)
    got = answer.evaluate(spark, asked, {"a": lambda q: texts}, seconds=12, at_once=8).collect()
    assert [r["question_id"] for r in got] == [f"q{i}" for i in range(8)] and most[0] == 8
    assert [r["executed"] for r in got] == [False] + [True] * 7 and all(r["correct"] for r in got[1:])


def held(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_a_small_upsert_rewrites_few_bytes(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    table = clustered.Clustered(spark, f"{tmp_path}/orders", ("o_orderkey",), rows=200)
    first = table.write(orders)
    n = orders.count()
    assert first.files >= 60 and first.new_bytes == first.bytes
    keys = sorted(r[0] for r in orders.select("o_orderkey").collect())[n // 2 : n // 2 + n // 100]
    new = orders.where(F.col("o_orderkey").between(keys[0], keys[-1])).withColumn("o_totalprice", F.lit(0).cast(orders.schema["o_totalprice"].dataType))
    report = table.upsert(new)
    assert new.count() >= n // 100 and 0 < report.new_bytes < 0.05 * report.bytes
    want = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey").between(keys[0], keys[-1]), F.lit(0)).otherwise(F.col("o_totalprice")).cast(orders.schema["o_totalprice"].dataType))
    assert held(table.read(), *orders.columns) == held(want, *orders.columns)
    assert held(table.read(version=1), *orders.columns) == held(orders, *orders.columns)
    assert len(table.read(low=keys[0], high=keys[5]).inputFiles()) <= 2 and table.read(low=keys[0], high=keys[5]).count() == 6
    gone = table.delete(F.col("o_orderkey").between(keys[0], keys[3]))
    assert gone.new_files <= 2 and table.read().count() == n - 4


def test_clustered_tables_take_odd_keys_and_new_columns(spark, tmp_path):
    kind = "id string, a int"
    table = clustered.Clustered(spark, f"{tmp_path}/t", ("id", "a"), rows=2)
    assert table.read() is None
    table.upsert(spark.createDataFrame([], kind))
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([("b", 1), ("d", 1), ("é", 1), (None, 1), ("b", 2), ("b", 1)], kind))
    table.upsert(spark.createDataFrame([("a", 1, "n"), ("b", 1, "n"), ("zz", 3, "n"), (None, 5, "n"), ("\U0001f600", 3, "n")], f"{kind}, note string"))
    want = {("b", 1, "n"), ("d", 1, None), ("é", 1, None), (None, 1, None), ("b", 2, None), ("a", 1, "n"), ("zz", 3, "n"), (None, 5, "n"), ("\U0001f600", 3, "n")}
    assert {tuple(r) for r in table.read().collect()} == want and table.read().count() == len(want)
    table.delete(F.col("id") == "b")
    assert {r["id"] for r in table.read().collect()} == {w[0] for w in want} - {"b"}
    table.delete(F.lit(True))
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([("x", 1)], kind))
    assert held(table.read(), "id", "note") == [("x", None)]


def test_of_two_writers_one_is_told(spark, tmp_path, monkeypatch):
    kind = "id long, v string"
    table = clustered.Clustered(spark, f"{tmp_path}/t", ("id",))
    table.write(spark.createDataFrame([(1, "a")], kind))
    commit = clustered.Clustered._commit

    def late(self, version, schema, files):
        monkeypatch.setattr(clustered.Clustered, "_commit", commit)
        clustered.Clustered(spark, f"{tmp_path}/t", ("id",)).upsert(spark.createDataFrame([(2, "other")], kind))  # first past the post
        commit(self, version, schema, files)

    monkeypatch.setattr(clustered.Clustered, "_commit", late)
    with pytest.raises(clustered.Conflict):
        table.upsert(spark.createDataFrame([(3, "mine")], kind))
    table.upsert(spark.createDataFrame([(3, "mine")], kind))
    assert held(table.read(), "id", "v") == [(1, "a"), (2, "other"), (3, "mine")]


def test_the_graph_store_drops_edges_without_ends(spark, tmp_path):
    graph = store.GraphStore(spark, str(tmp_path), rows=2)
    graph.write_nodes("Table", spark.createDataFrame([(f"t{i}", i) for i in range(9)], "id string, n int"))
    report = graph.write_nodes("Table", spark.createDataFrame([("t3", 30)], "id string, n int"))
    assert report.new_files < report.files and {r["n"] for r in graph.read("Table").collect()} == {0, 1, 2, 30, 4, 5, 6, 7, 8}
    graph.write_edges("REF", spark.createDataFrame([("t1", "t2"), ("t1", "t2"), ("t1", "gone"), ("t4", "t5")], "source_id string, target_id string"), "Table", "Table")
    assert held(graph.read("REF"), "source_id", "target_id") == [("t1", "t2"), ("t4", "t5")]


def plain_scores(docs, asked, bm25, weights=None):
    """(question, document) -> score, exhaustive; docs: (id, field, text)."""
    import re
    from collections import Counter

    split = lambda t: [w for w in re.split("[^a-z0-9]+", (t or "").lower()) if w]
    stats, posts = {}, {}
    for field in {f for _, f, _ in docs}:
        lengths = [len(split(t)) for _, f, t in docs if f == field]
        stats[field] = (len(lengths), sum(lengths) / len(lengths))
    for i, f, t in docs:
        for w, tf in Counter(split(t)).items():
            posts.setdefault((f, w), []).append((i, tf, len(split(t))))
    out = {}
    for q, text in asked:
        for w in set(split(text)):
            for (f, v), found in posts.items():
                if v == w:
                    n, mean = stats[f]
                    df = len(found)
                    for i, tf, length in found:
                        s = math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean)) if bm25 else tf * math.log((n + 1) / (df + 0.5))
                        out[q, i] = out.get((q, i), 0) + s * (weights or {}).get(f, 1)
    return out


@pytest.mark.parametrize("bm25", [True, False])
def test_fulltext_equals_an_exhaustive_search(spark, bm25, monkeypatch):
    monkeypatch.setattr(fulltext, "BLOCK", 8)
    monkeypatch.setattr(fulltext, "AT_ONCE", 7)
    rng = random.Random(3)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 300}"
    docs = [(i, f, " ".join(word() for _ in range(rng.choice([3, 20, 200])))) for i in range(120) for f in ("name", "comment") if rng.random() < 0.9]
    docs += [(500, "name", None), (501, "name", ""), (502, "name", "Same-words, same WORDS"), (503, "name", "same words same words"), (504, "comment", "-- ..")]
    asked = [(f"q{i}", " ".join(word() for _ in range(rng.randrange(1, 30)))) for i in range(20)] + [("same", "words same"), ("none", "zzz"), ("null", None), (None, "w1 w2")]
    weights = {"name": 1.5}
    want = plain_scores(docs, [a for a in asked if a[0] is not None], bm25, weights)
    frame, questions = spark.createDataFrame(docs, "id long, field string, text string").repartition(3), spark.createDataFrame(asked, "question_id string, text string")
    got = {}
    for r in fulltext.topk(questions, frame, 4, bm25, weights).collect():
        got.setdefault(r["question_id"], []).append((r["rank"], r["id"], r["score"]))
    for q in {q for q, _ in want}:
        best = sorted(((-round(s, 4), i) for (p, i), s in want.items() if p == q))[:4]
        assert [(n, i, pytest.approx(-s, abs=2e-4)) for n, (s, i) in enumerate(best, 1)] == sorted(got[q])
    assert set(got) == {q for q, _ in want}
    assert fulltext.topk(questions, frame.limit(0), 4, bm25).count() == 0 and fulltext.topk(questions.limit(0), frame, 4, bm25).count() == 0


def test_few_pairs_are_ranked(spark, tmp_path):
    asked = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("question_id"), "text")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    pairs = asked.count() * docs.count()
    fulltext.build(docs, True).write(f"{tmp_path}/index")
    found = fulltext.search(fulltext.TextIndex.read(spark, f"{tmp_path}/index"), asked, 5)
    assert found.found.count() < pairs / 10
    blocks = found.visits.select("block").distinct().count()
    assert found.visits.count() < asked.count() * blocks  # some blocks are left out for some questions
    assert held(found.top(5, 4), "question_id", "id", "score", "rank") == held(fulltext.topk(asked, docs, 5, bm25=True), "question_id", "id", "score", "rank")


def near_items(rng, n, dims):
    centres = rng.standard_normal((12, dims))
    return centres[rng.integers(0, 12, n)] + 0.05 * rng.standard_normal((n, dims))


def test_cells_give_the_nearest_and_spare_most(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(vectorindex, "SLOT", 60)
    rng = np.random.default_rng(4)
    x = near_items(rng, 2000, 8)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 8), (5002, [1.0]), (5003, [math.nan] * 8), (5004, [None] * 8), (5005, x[0].tolist()), (5006, x[0].tolist())]
    items = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    asked = items.where("id % 50 = 0").withColumnRenamed("id", "question_id")
    index = vectorindex.build(items)
    got = {}
    for r in vectorindex.topk(asked, index, 7, apart=True).collect():
        got.setdefault(r["question_id"], {})[r["rank"]] = (r["id"], r["score"])
    good = [(i, np.array(v)) for i, v in rows if i < 2000 or i in (5005, 5006)]
    for q in [i for i, _ in good if i % 50 == 0]:
        own = dict(good)[q]
        best = sorted((-round(float(own @ v) / (np.linalg.norm(own) * np.linalg.norm(v)), 6), i) for i, v in good if i != q)[:7]
        assert [(i, pytest.approx(-s, abs=2e-6)) for s, i in best] == [got[q][n] for n in range(1, 8)]
    assert set(got) == {i for i, _ in good if i % 50 == 0}
    met = index.visits(vectorindex._usable(asked, 8), 7).join(index.items.select("_cell", "_slot"), ["_cell", "_slot"]).count()
    assert met < 0.3 * len(got) * len(good)
    index.write(f"{tmp_path}/index")
    again = vectorindex.topk(asked, vectorindex.VectorIndex.read(spark, f"{tmp_path}/index"), 7, apart=True)
    assert {(r["question_id"], r["rank"]): (r["id"], r["score"]) for r in again.collect()} == {(q, n): v for q, some in got.items() for n, v in some.items()}
    assert vectorindex.topk(asked, vectorindex.build(items.limit(0)), 7).count() == 0


def test_copies_and_useless_vectors_in_packs(spark, monkeypatch):
    """Packs of a few items, pieces of a few scores, a vector with many copies, drawn rows of no use; scores equal a plain search's."""
    monkeypatch.setattr(vectorindex, "FEWEST", 50)
    monkeypatch.setattr(vectorindex, "PACKS", 9)
    monkeypatch.setattr(vectorindex, "SCORES", 900)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((700, 5)).astype(np.float32)
    x[300:500] = x[10]
    x[20] = -x[10]
    rows = [(f"i{i}", v.tolist()) for i, v in enumerate(x)] + [(f"z{i}", [0.0] * 5) for i in range(3000)]
    items = spark.createDataFrame(rows, "id string, vector array<float>").repartition(3)
    asked = items.where("id in ('i1', 'i10', 'i20', 'i300', 'z5')").withColumnRenamed("id", "question_id")
    index = vectorindex.build(items)
    assert index.items.schema["_v"].dataType.elementType.typeName() == "float" and len(set(index.packs().values())) > 5
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    for apart in (True, False):
        want = set()
        for q in (1, 10, 20, 300):
            best = sorted((-round(float(unit[q] @ unit[i]), 6), f"i{i}") for i in range(700) if not apart or i != q)[:30]
            want |= {(f"i{q}", n, i) for n, (_, i) in enumerate(best, 1)}
        assert {(r["question_id"], r["rank"], r["id"]) for r in vectorindex.topk(asked, index, 30, apart).collect()} == want
    # Tasks give on the k best of their pack only, so that no more pairs than that are shuffled.
    plan = vectorindex.topk(asked, index, 30)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.replace("BroadcastHashJoin", "") and "MapInArrow" in plan


def test_a_stored_index_is_a_file_a_task(spark, tmp_path):
    """It was one for each cell and task, some 90 here; and the longest vectors count though none of them is drawn."""
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((2000, 6)))], "id long, vector array<double>").repartition(3)
    index = vectorindex.build(items)
    index.write(f"{tmp_path}/index")
    files = [f for _, _, names in os.walk(f"{tmp_path}/index/items") for f in names if f.endswith(".parquet")]
    assert len(index.cells) > 20 and len(files) <= 3
    assert vectorindex.VectorIndex.read(spark, f"{tmp_path}/index").items.count() == 2000
    first = items.orderBy(F.xxhash64("id"), "id").limit(100).select("id")
    longer = items.join(first, "id", "left_anti").limit(1).select("id", F.concat("vector", F.array(F.lit(1.0))).alias("vector"))
    mixed = vectorindex.build(items.join(longer.select("id"), "id", "left_anti").unionByName(longer))
    assert mixed.width == 7 and mixed.items.count() == 1


def test_a_first_look_in_single_precision_loses_nothing():
    """Cosines that single precision can't tell apart are ranked as double precision does, and ties by id."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal(16) + 1e-3 * rng.standard_normal((4000, 16))
    x[::7] = x[0]
    batch = lambda **c: pa.RecordBatch.from_pydict(c)
    pack = vectorindex._Pack([batch(id=list(range(4000)), _v=x.tolist(), _cells=[[i % 5] for i in range(4000)])], 16)
    assert pack.near.dtype == np.float32
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    for cells in (list(range(5)), [1, 3]):  # all at once, and by cell
        asked = batch(id=[7, None], question_id=[7, 8], _v=[x[7].tolist(), x[8].tolist()], _cells=[cells, cells])
        got = [(r["question_id"], r["id"]) for b in pack.answers(asked, 16, 12) for r in b.to_pylist()]
        there = [i for i in range(4000) if i % 5 in cells]
        best = lambda q, apart: sorted((-np.floor(float(unit[q] @ unit[i]) * 1e6 + 0.5), i) for i in there if i != apart)[:12]  # noqa: B023, E731
        assert got == [(q, i) for q, apart in ((7, 7), (8, None)) for _, i in best(q, apart)]


def joins(spark, name):
    from semgraph.plans import queries_graph as G

    return getattr(G, name)(spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_tables_of_found_columns_need_no_join(spark):
    """column_level_topk joined all vectors to what its search had found; a found item brings its table along."""
    assert joins(spark, "column_level_topk") == 0
    items = spark.createDataFrame([(i, [1.0, float(i)], f"t{i % 3}") for i in range(40)] + [(50, [1.0, 7.0], None)], "id long, vector array<double>, source_id string")
    found = vectorindex.topk(spark.createDataFrame([(7, [1.0, 7.0])], "question_id long, vector array<double>"), vectorindex.build(items), 4, apart=True, keep=("source_id",))
    assert [(r["id"], r["source_id"]) for r in found.orderBy("rank").collect()] == [(50, None), (8, "t2"), (6, "t0"), (9, "t0")]


def test_packs_are_no_more_than_keep_tasks_busy(spark):
    """A query was sent to 48 packs wherever they held 4096 items; and each pack is a partition."""
    index = vectorindex.VectorIndex(None, np.zeros((256, 2)), [(c, 2400, 0.5) for c in range(256)])
    assert len(set(index.packs().values())) == 48 and len(set(index.packs(12).values())) == 12
    assert max(np.bincount([p for (c, _), p in index.packs(12).items()])) <= 22
    rng = np.random.default_rng(8)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((20_000, 4)))], "id long, vector array<double>")
    plan = vectorindex.topk(items.where("id < 3").withColumnRenamed("id", "question_id"), vectorindex.build(items), 3)._jdf.queryExecution().toString()
    assert "_pack" in plan and "hashpartitioning(_pack" not in plan


def test_many_equal_items_are_settled_in_pieces(monkeypatch):
    """Products by tiles, and more equal items than a task holds scores of, give what a plain search does."""
    monkeypatch.setattr(vectorindex, "TILE", 96)
    monkeypatch.setattr(vectorindex, "SCORES", 960)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 6)).astype(np.float32)
    x[500:2500] = x[3]
    batch = lambda n, **c: pa.RecordBatch.from_pydict(c | {"_b": pa.array([v.tobytes() for v in x[:n]], pa.binary())})
    pack = vectorindex._Pack([batch(3000, id=[f"{i:04d}" for i in range(3000)], _cells=[[i % 7] for i in range(3000)], label=list(range(3000)))], 6, ("label",))
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    for cells in (list(range(7)), [2, 5]):
        asked = batch(20, id=[f"{i:04d}" for i in range(20)], question_id=list(range(20)), _cells=[cells] * 20)
        got = [(r["question_id"], r["label"], r["id"]) for b in pack.answers(asked, 6, 25) for r in b.to_pylist()]
        there = [i for i in range(3000) if i % 7 in cells]
        assert got == [(q, i, f"{i:04d}") for q in range(20) for _, i in sorted((-np.floor(float(unit[q] @ unit[i]) * 1e6 + 0.5), i) for i in there if i != q)[:25]]


def test_schemas_are_chosen_from_one_search(spark):
    """select_schema joined the labels to what was found, and did so for each of its two indexes."""
    from semgraph.operators import retrieve

    assert joins(spark, "select_schema") == 0
    rows = [(q, i, f"c.s{(q + i) % 3}.t{i}", float(i + q)) for q in range(4) for i in range(9)] + [(9, 1, "c.s1.t", 0.0)]
    seeds = spark.createDataFrame([(q, i % 2, name, score) for q, i, name, score in rows], "question_id long, index long, id string, score double")
    kept = lambda df: sorted(map(tuple, df.select("question_id", "schema", "share", "rank").collect()))
    assert kept(retrieve.schemas_of(seeds)) == kept(retrieve.select_schemas(seeds.where("index = 0"), seeds.where("index = 1"))) != []


def test_a_stored_index_keeps_vectors_as_bytes_and_columns(spark, tmp_path):
    """Lists were written entry by entry; and retrieval_metrics joined all labels twice, now those of the questions."""
    assert joins(spark, "retrieval_metrics") == 1
    rng = np.random.default_rng(10)
    for kind in ("float", "double"):
        rows = [(i, v.astype(np.float32).tolist(), i % 5) for i, v in enumerate(rng.standard_normal((300, 6)))]
        vectorindex.build(spark.createDataFrame(rows, f"id long, vector array<{kind}>, label int")).write(f"{tmp_path}/{kind}")
        again = vectorindex.VectorIndex.read(spark, f"{tmp_path}/{kind}")
        assert again.packed.schema["_b"].dataType.typeName() == "binary" and again.items.schema["_v"].dataType.elementType.typeName() == kind
        assert sorted((r["id"], r["_v"], r["label"]) for r in again.items.collect()) == rows


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_vector_searches_have_no_nested_loop(spark, threshold):
    from semgraph.plans import queries_graph as G

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for name in ("cosine_topk", "vector_prefilter_topk", "column_level_topk"):
            plan = getattr(G, name)(spark, SF)._jdf.queryExecution().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
