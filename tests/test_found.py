"""Keys and references found in rows, and relations that grow with the given tables."""

import pytest

from semgraph.operators import fk
from semgraph.queries import queries
from semgraph.registry import GROWN, fixture
from semgraph.sources import found, metadata

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    rows = lambda data, shape: spark.createDataFrame(data, shape)
    return {
        "a": rows([(1, "x", 1), (2, "x", 1), (3, None, 2)], "id int, name string, n int"),
        "b": rows([(1, 1), (1, 2), (2, 1), (2, 1)], "a int, b int"),
        "c": rows([(1, 1), (1, 2), (None, 7), (3, None)], "a_id int, n int"),
        "none": rows([], "id int, x int"),
    }


def test_keys_hold_in_every_row(tables):
    constraints, usage = found.keys(tables, {"a": [["name"], ["id"], ["n", "id"]], "b": [["a", "b"]], "c": [["a_id"]], "none": [["id"], ["x"]]})
    got = {(r["table_name"], r["constraint_type"], r["ordinal_position"], r["column_name"]) for r in metadata.key_constraints(constraints, usage).collect()}
    assert got == {("a", "PRIMARY KEY", 1, "id"), ("a", "UNIQUE", 1, "n"), ("a", "UNIQUE", 2, "id"), ("none", "PRIMARY KEY", 1, "id"), ("none", "UNIQUE", 1, "x")}


def test_references_hold_but_for_nulls(tables):
    _, usage = found.keys(tables, {"a": [["id"]], "b": [["a"]]})
    tried = [("c", ["a_id"], "a", ["id"]), ("c", ["n"], "a", ["id"]), ("c", ["a_id", "n"], "b", ["a", "b"]), ("none", ["id"], "a", ["id"]), ("a", ["id"], "none", ["id"])]
    referential, more = found.references(tables, tried)
    pairs = metadata.declared_pairs(referential, usage.unionByName(more))
    assert {(r["source_id"], r["target_id"]) for r in fk.declared(pairs).collect()} == {("lake.main.c.a_id", "lake.main.a.id"), ("lake.main.none.id", "lake.main.a.id")}
    # The pair of columns refers to columns that are no key.
    assert fk.unresolved(referential, pairs).count() == 1


@pytest.mark.parametrize("name", sorted(GROWN))
def test_relations_grow_with_the_tables(spark, name):
    made, whole = fixture(spark, name), fixture(spark, name, SF)
    assert whole.columns == made.columns and whole.inputFiles()
    assert whole.count() > made.count()


@pytest.mark.parametrize("name", ["pk_gate", "fk_infer_comments", "fk_fanout", "fk_discover", "prompts", "ddl_keys", "generated_text", "ordered_ids"])
def test_queries_read_the_given_tables(spark, name):
    assert any(SF in f for f in queries()[name](spark, SF).inputFiles())


def test_lists_of_catalogs(spark):
    lists = spark.createDataFrame([(1, "a:x, b ,a:y,,c:"), (2, " "), (3, None)], "id int, l string")
    got = sorted(tuple(r) for r in metadata.listed_catalogs(lists, "l", ["id"]).collect())
    assert got == [(1, 0, "a", "x"), (1, 1, "b", None), (1, 4, "c", "")]
    assert [tuple(r) for r in metadata.resolve_catalogs(spark, "only", " ").collect()] == [(0, "only", None)]
