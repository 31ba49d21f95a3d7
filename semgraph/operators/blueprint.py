"""Blueprints of schemas into tables (OP-MATERIALIZE, OP-CANDIDATES, SRC-12, SRC-19, SNK-08, ARR-05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import constraint_name, sanitize_identifier, schema_name, sql_literal
from ..functions.types import coerce_type

BLUEPRINT = (
    "schemas array<struct<source_id string, uc_schema string, tables array<struct<name string, "
    "columns array<struct<name string, type string, comment string>>, primary_key array<string>, "
    "foreign_keys array<struct<columns array<string>, foreign_table string, referred_columns array<string>>>, rows array<array<string>>>>>>"
)
SLICE = "map<string, struct<TABLES map<string, struct<COLUMNS map<string, struct<TYPE string, VALUES array<string>>>, PRIMARY_KEYS array<string>, FOREIGN_KEYS array<struct<COLUMNS array<string>, FOREIGN_TABLE string, REFERRED_COLUMNS array<string>>>>>>>"


def read_blueprint(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: (schema, table) rows of a blueprint file; one without schemas gives none."""
    whole = spark.read.schema(BLUEPRINT).option("multiLine", True).json(path)
    one = whole.select(F.explode("schemas").alias("s"))
    return one.select(F.col("s.source_id").alias("source_id"), F.col("s.uc_schema").alias("schema"), F.explode("s.tables").alias("t")).select("source_id", "schema", F.col("t.name").alias("table"), "t.columns", "t.primary_key", "t.foreign_keys", "t.rows")


def read_slice(spark: SparkSession, path: str) -> DataFrame:
    """SRC-19: the same columns from a slice of nested maps."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", SLICE).alias("m"))
    tables = text.select(F.explode("m").alias("source_id", "s")).select("source_id", F.explode("s.TABLES").alias("table", "t"))
    columns = F.transform(F.map_entries("t.COLUMNS"), lambda e: F.struct(e["key"].alias("name"), e["value"]["TYPE"].alias("type"), F.lit(None).cast("string").alias("comment")))
    keys = F.transform("t.FOREIGN_KEYS", lambda k: F.struct(k["COLUMNS"].alias("columns"), k["FOREIGN_TABLE"].alias("foreign_table"), k["REFERRED_COLUMNS"].alias("referred_columns")))
    lists = F.transform(F.map_values("t.COLUMNS"), lambda v: v["VALUES"])
    return tables.select("source_id", schema_name("source_id").alias("schema"), "table", columns.alias("columns"), F.col("t.PRIMARY_KEYS").alias("primary_key"), keys.alias("foreign_keys"), zipped_rows(lists).alias("rows"))


def zipped_rows(lists, most: int = 20):
    """ARR-05: rows from the values of each column, by place, ``most`` at the utmost; none where their numbers differ."""
    sizes = F.transform(lists, lambda v: F.coalesce(F.size(v), F.lit(0)))
    n = F.least(F.array_max(sizes), F.lit(most))
    even = F.array_min(sizes) == F.array_max(sizes)
    rows = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(lists, lambda v: F.element_at(v, i)))
    return F.when(even & (n > 0), rows).otherwise(F.array().cast("array<array<string>>"))


def planned_columns(tables: DataFrame) -> DataFrame:
    """Columns with clean names and lake types; unnamed ones go, and of several with one clean name all but the first."""
    one = tables.select("schema", sanitize_identifier("table", "t").alias("table"), F.posexplode("columns").alias("place", "c"))
    typed = one.select("schema", "table", "place", sanitize_identifier("c.name", "c").alias("column"), coerce_type("c.type").alias("k"), F.col("c.comment").alias("comment")).where("table <> '' and `column` <> ''")
    first = Window.partitionBy("schema", "table", "column").orderBy("place")
    return typed.withColumn("rn", F.row_number().over(first)).where("rn = 1").select("schema", "table", "place", "column", F.col("k.lake_type").alias("lake_type"), F.col("k.fallback").alias("fallback"), "comment")


def planned_primary_keys(tables: DataFrame, planned: DataFrame) -> DataFrame:
    """Primary keys all of whose columns are still there and hold no null in the sample rows, with their names."""
    places = tables.select("schema", sanitize_identifier("table", "t").alias("table"), F.transform("columns", lambda c: sanitize_identifier(c["name"], "c")).alias("names"), "rows", F.transform("primary_key", lambda k: sanitize_identifier(k, "c")).alias("key"))
    known = planned.groupBy("schema", "table").agg(F.collect_set("column").alias("have"))
    ok = F.size(F.array_except("key", "have")) == 0
    null_free = F.forall("key", lambda k: F.forall(F.coalesce("rows", F.array().cast("array<array<string>>")), lambda r: F.get(r, F.array_position("names", k).cast("int") - 1).isNotNull()))
    return places.where(F.size("key") > 0).join(known, ["schema", "table"]).where(ok & null_free).select("schema", "table", "key", constraint_name("pk", F.col("schema"), F.col("table")).alias("name"))


def planned_foreign_keys(tables: DataFrame, planned: DataFrame) -> DataFrame:
    """Foreign keys of equal arity whose columns, and whose parent's columns, are there, with their names."""
    one = tables.select("schema", sanitize_identifier("table", "t").alias("table"), F.explode("foreign_keys").alias("k"))
    clean = lambda c: F.transform(c, lambda x: sanitize_identifier(x, "c"))
    keys = one.select("schema", "table", clean(F.col("k.columns")).alias("columns"), sanitize_identifier("k.foreign_table", "t").alias("parent"), clean(F.col("k.referred_columns")).alias("referred"))
    have = planned.groupBy("schema", "table").agg(F.collect_set("column").alias("have"))
    parents = have.select("schema", F.col("table").alias("parent"), F.col("have").alias("parent_have"))
    valid = keys.where((F.size("columns") > 0) & (F.size("columns") == F.size("referred"))).join(have, ["schema", "table"]).join(parents, ["schema", "parent"])
    valid = valid.where((F.size(F.array_except("columns", "have")) == 0) & (F.size(F.array_except("referred", "parent_have")) == 0))
    return valid.select("schema", "table", "columns", "parent", "referred", constraint_name("fk", F.col("schema"), F.col("table"), F.array_join("columns", "_"), F.col("parent")).alias("name"))


def _quoted(name: Column) -> Column:
    return F.concat(F.lit("`"), name, F.lit("`"))


def _listed(names: Column) -> Column:
    return F.array_join(F.transform(names, _quoted), ", ")


def _full_name(catalog: str, table: str = "table") -> Column:
    return F.concat(F.lit(f"`{catalog}`."), _quoted(F.col("schema")), F.lit("."), _quoted(F.col(table)))


def statements(planned: DataFrame, catalog: str, keys: DataFrame | None = None) -> DataFrame:
    """SNK-08: a CREATE TABLE for each planned table; keys: primary keys (as by planned_primary_keys), declared inline, their columns NOT NULL."""
    if keys is None:
        keyed = planned.withColumns({"key": F.lit(None).cast("array<string>"), "name": F.lit(None).cast("string")})
    else:
        keyed = planned.join(keys.select("schema", "table", "key", "name"), ["schema", "table"], "left")
    in_key = F.coalesce(F.array_contains("key", F.col("column")), F.lit(False))
    line = F.concat(_quoted(F.col("column")), F.lit(" "), F.col("lake_type"), F.when(in_key, " NOT NULL").otherwise(""))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))), lambda r: r["line"])
    made = keyed.groupBy("schema", "table", "key", "name").agg(lines.alias("lines"))
    clause = F.when(F.col("key").isNotNull(), F.concat(F.lit(", CONSTRAINT "), _quoted(F.col("name")), F.lit(" PRIMARY KEY ("), _listed(F.col("key")), F.lit(")"))).otherwise("")
    return made.select("schema", "table", F.concat(F.lit("CREATE TABLE "), _full_name(catalog), F.lit(" ("), F.array_join("lines", ", "), clause, F.lit(")")).alias("ddl"))


def foreign_key_statements(keys: DataFrame, catalog: str) -> DataFrame:
    """SNK-08: an ALTER TABLE for each foreign key (as by planned_foreign_keys)."""
    add = F.concat(
        F.lit("ALTER TABLE "), _full_name(catalog), F.lit(" ADD CONSTRAINT "), _quoted(F.col("name")),
        F.lit(" FOREIGN KEY ("), _listed(F.col("columns")), F.lit(") REFERENCES "), _full_name(catalog, "parent"), F.lit(" ("), _listed(F.col("referred")), F.lit(")"),
    )
    return keys.select("schema", "table", "name", add.alias("ddl"))


def insert_statements(tables: DataFrame, planned: DataFrame, catalog: str) -> DataFrame:
    """SNK-08: an INSERT OVERWRITE of each table's sample rows, if it has any; cells are cast to their column's type."""
    columns = planned.groupBy("schema", "table").agg(F.array_sort(F.collect_list(F.struct("place", "column", "lake_type"))).alias("cs"))
    rows = tables.select("schema", sanitize_identifier("table", "t").alias("table"), F.posexplode("rows").alias("n", "r")).join(columns, ["schema", "table"])

    def cell(c: Column) -> Column:
        literal = sql_literal(F.get("r", c["place"]))
        return F.when((c["lake_type"] == "STRING") | (literal == "NULL"), literal).otherwise(F.concat(F.lit("CAST("), literal, F.lit(" AS "), c["lake_type"], F.lit(")")))

    tuples = rows.select("schema", "table", "n", F.transform("cs", lambda c: c["column"]).alias("names"), F.concat(F.lit("("), F.array_join(F.transform("cs", cell), ", "), F.lit(")")).alias("t"))
    made = tuples.groupBy("schema", "table", "names").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "t"))), lambda x: x["t"]), ", ").alias("v"))
    return made.select("schema", "table", F.concat(F.lit("INSERT OVERWRITE "), _full_name(catalog), F.lit(" ("), _listed(F.col("names")), F.lit(") VALUES "), F.col("v")).alias("ddl"))


def table_properties(tables: DataFrame, prefix: str) -> DataFrame:
    """JSN-01: (schema, table, properties): where a table comes from and its keys as they were given, as JSON."""
    keys = F.to_json(F.coalesce("foreign_keys", F.array().cast(tables.schema["foreign_keys"].dataType)))
    primary = F.to_json(F.coalesce("primary_key", F.array().cast("array<string>")))
    named = {"source_id": F.col("source_id"), "original_name": F.col("table"), "primary_keys": primary, "foreign_keys": keys}
    properties = F.create_map(*(x for k, v in named.items() for x in (F.lit(f"{prefix}.{k}"), v)))
    return tables.select("schema", sanitize_identifier("table", "t").alias("table"), properties.alias("properties"))


def ranked_candidates(tables: DataFrame, least: int, most: int, least_fks: int, limit: int) -> DataFrame:
    """OP-CANDIDATES, FLT-09, AGG-18, SRT-06, STR-07: sources of fitting size by density of foreign keys, with unique schema names.

    tables: (source_id, table, n_fks, n_rows).
    """
    size = tables.groupBy("source_id").agg(F.count("*").alias("n_tables"), F.sum("n_fks").alias("n_fks"), F.sum("n_rows").alias("n_rows"))
    fit = size.where(F.col("n_tables").between(least, most) & (F.col("n_fks") >= least_fks) & (F.col("n_rows") > 0))
    best = fit.withColumn("density", F.round(F.col("n_fks") / F.col("n_tables"), 6)).orderBy(F.desc("density"), "source_id").limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("density"), "source_id"))
    named = best.withColumn("rank", rank).withColumn("name", schema_name("source_id"))
    nth = F.row_number().over(Window.partitionBy("name").orderBy("rank"))
    return named.withColumn("nth", nth).select("source_id", "n_tables", "n_fks", "density", "rank", F.when(F.col("nth") > 1, F.concat_ws("_", "name", F.col("nth").cast("string"))).otherwise(F.col("name")).alias("schema"))
