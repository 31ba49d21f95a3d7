"""Sample rows and the prompts that show them."""

import hashlib
import json

import pytest

from semgraph.operators import dense, questions, samples


def plain(rows, k):
    """Rows (dicts in column order) by the md5 of their texts."""
    text = lambda v: "-" if v is None else f"{len(str(v))}:{v}"
    made = [(hashlib.md5("|".join(["0", *map(text, r.values())]).encode()).hexdigest(), json.dumps(r, separators=(",", ":"))) for r in rows]
    return [(i, *x) for i, x in enumerate(sorted(made)[:k], 1)]


def test_samples_are_the_same_at_any_partitioning(spark):
    rows = [{"a": i % 97 or None, "b": None if i % 5 == 0 else f"t{i % 31}"} for i in range(800)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "a long, b string")
    few, none = df.limit(0).union(spark.createDataFrame([(1, "x|2:y")], "a long, b string")), df.limit(0)
    for n in (1, 7):
        got = samples.sample_rows({"many": df.repartition(n), "few": few, "none": none}, 6).collect()
        assert sorted((r["place"], r["hash"], r["row"]) for r in got if r["table"] == "many") == plain(rows, 6)
        assert [(r["place"], r["hash"], r["row"]) for r in got if r["table"] == "few"] == plain([{"a": 1, "b": "x|2:y"}], 6)
        assert {r["table"] for r in got} == {"many", "few"}
    with pytest.raises(ValueError):
        samples.sample_rows({"many": df}, 0)


def test_long_texts_are_cut_where_they_are_shown(spark):
    df = spark.createDataFrame([(1, "x" * 500, "clash")], "id long, row string, hash string")
    got = samples.sample_rows({"t": df}, keys={"t": ["id"]}, most=5).collect()
    assert json.loads(got[0]["row"]) == {"id": 1, "row": "xxxxx...", "hash": "clash"}
    assert got[0]["hash"] == hashlib.md5(b"0|1:1").hexdigest()


def test_prompts_show_samples(spark):
    columns = spark.createDataFrame([("a", 0, "id", "BIGINT", None), ("a", 1, "b_id", "BIGINT", "b"), ("b", 0, "id", "BIGINT", None), ("c", 0, "v", "STRING", None)], '`table` string, place int, `column` string, type string, parent string')
    shown = spark.createDataFrame([("a", 2, '{"id":2}'), ("a", 1, '{"id":1}')], "`table` string, place int, row string")
    lines = dense.ddl_prompt(columns, shown)
    assert {r["table"]: r["line"] for r in lines.collect()} == {"a": '- a(id BIGINT, b_id BIGINT) PK(id) FKs: b_id->b Samples: [{"id":1}, {"id":2}]', "b": "- b(id BIGINT) PK(id)", "c": "- c(v STRING)"}
    groups = spark.createDataFrame([("b", "b", 0), ("b", "a", 1), ("b", "gone", 1), ("x", "gone", 0)], "seed string, `table` string, depth int")
    got = questions.batch_prompts(groups, lines, "lake", "main", 3).collect()
    assert [(r["seed"], r["n_tables"]) for r in got] == [("b", 2)]
    prompt = got[0]["prompt"]
    assert prompt.index("- b(id") < prompt.index("- a(id") and "Write 12 questions" in prompt and "at least 4 of each" in prompt and "catalog 'lake'" in prompt
