"""A dense synthetic schema from templates and domain terms (OP-DENSEGEN, OP-DENSETPL, OP-DENSETERMS, OP-DDLPROMPT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Ten kinds of table: (kind, columns, foreign keys as column>table).  ``{t}`` is the term, ``{d}`` the domain.
TEMPLATES = [
    ("entity", "id BIGINT,name STRING,status STRING,owner_id BIGINT,created_at TIMESTAMP", "owner_id>hr_employees"),
    ("event", "id BIGINT,{t}_id BIGINT,actor_id BIGINT,event_type STRING,occurred_at TIMESTAMP", "{t}_id>{d}_{t};actor_id>sys_users"),
    ("lines", "id BIGINT,{t}_id BIGINT,quantity INT,amount DECIMAL(14,2)", "{t}_id>{d}_{t}"),
    ("config", "id BIGINT,{t}_id BIGINT,config_key STRING,config_value STRING", "{t}_id>{d}_{t}"),
    ("analytics", "id BIGINT,{t}_id BIGINT,metric STRING,value DOUBLE,as_of DATE", "{t}_id>{d}_{t}"),
    ("approval", "id BIGINT,{t}_id BIGINT,approver_id BIGINT,decision STRING", "{t}_id>{d}_{t};approver_id>hr_employees"),
    ("notification", "id BIGINT,{t}_id BIGINT,user_id BIGINT,channel STRING,sent_at TIMESTAMP", "{t}_id>{d}_{t};user_id>sys_users"),
    ("integration", "id BIGINT,{t}_id BIGINT,system STRING,external_ref STRING", "{t}_id>{d}_{t}"),
    ("schedule", "id BIGINT,{t}_id BIGINT,starts_at TIMESTAMP,ends_at TIMESTAMP", "{t}_id>{d}_{t}"),
    ("archive", "id BIGINT,{t}_id BIGINT,archived_by BIGINT,archived_at TIMESTAMP", "{t}_id>{d}_{t};archived_by>sys_users"),
]


def selected_terms(terms: DataFrame, seed: int, count: int = 10) -> DataFrame:
    """OP-DENSETERMS: of (domain, term, required) so many terms of each domain: required ones first, the rest by md5."""
    order = Window.partitionBy("domain").orderBy(F.desc("required"), F.md5(F.concat(F.lit(f"{seed}|"), F.col("term"))), "term")
    return terms.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= count).drop("rn")


def dense_tables(spark: SparkSession, terms: DataFrame, templates: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """OP-DENSETPL: (table, kind, place, column, type, parent): the columns of every term's ten tables."""
    kinds = spark.createDataFrame(templates or TEMPLATES, "kind string, columns string, fks string")
    fill = lambda c: F.replace(F.replace(F.col(c), F.lit("{t}"), F.col("term")), F.lit("{d}"), F.col("domain"))
    # The template table has one row a kind; each term is joined to all of them.
    both = terms.join(F.broadcast(kinds)).withColumns({"columns": fill("columns"), "fks": fill("fks"), "table": F.concat(F.concat_ws("_", "domain", "term"), F.when(F.col("kind") == "entity", "").otherwise(F.concat(F.lit("_"), F.col("kind"))))})
    parents = F.map_from_entries(F.transform(F.split("fks", ";"), lambda x: F.struct(F.substring_index(x, ">", 1), F.substring_index(x, ">", -1))))
    rows = both.select("table", "kind", parents.alias("parents"), F.posexplode(F.split("columns", ",(?=[a-z])")).alias("place", "c"))
    name = F.substring_index("c", " ", 1)
    return rows.select("table", "kind", "place", name.alias("column"), F.substring_index("c", " ", -1).alias("type"), F.element_at("parents", name).alias("parent"))


def dense_rows(spark: SparkSession, columns: DataFrame, count: int = 10, seed: int = 7) -> DataFrame:
    """OP-DENSEGEN: (table, row, column, value): seeded values by type; keys run from 1."""
    rows = columns.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(count).cast("long"))))
    h = F.pmod(F.xxhash64("table", "column", "row", F.lit(seed)), F.lit(1000)).cast("long")
    base = F.upper("type")
    value = (
        F.when(F.col("column") == "id", F.col("row").cast("string"))
        .when(F.col("column").endswith("_id") | F.col("parent").isNotNull(), (1 + F.pmod(h, F.lit(count))).cast("string"))
        .when(base.startswith("DECIMAL") | (base == "DOUBLE"), (h / 10).cast("string"))
        .when(base.isin("INT", "BIGINT"), h.cast("string"))
        .when(base == "DATE", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(h, F.lit(365)).cast("int")).cast("string"))
        .when(base == "TIMESTAMP", F.concat(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(h, F.lit(365)).cast("int")).cast("string"), F.lit(" 00:00:00")))
        .otherwise(F.concat_ws("_", "column", h.cast("string")))
    )
    return rows.select("table", "row", "column", value.alias("value"))


def ddl_prompt(columns: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """OP-DDLPROMPT: (table, line): ``- table(cols) PK(id) FKs: a->b``, and `` Samples: [rows]`` where ``samples`` (table, place, row) has some."""
    ordered = lambda c, when=None: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("place", c.alias("x"))) if when is not None else F.struct("place", c.alias("x")))), lambda r: r["x"]), ", ")
    shape = columns.groupBy("table").agg(
        ordered(F.concat_ws(" ", "column", "type")).alias("cols"),
        ordered(F.col("column"), F.col("column") == "id").alias("pk"),
        ordered(F.concat(F.col("column"), F.lit("->"), F.col("parent")), F.col("parent").isNotNull()).alias("fks"),
    )
    key = F.when(F.col("pk") != "", F.concat(F.lit(" PK("), F.col("pk"), F.lit(")"))).otherwise("")
    fks = F.when(F.col("fks") != "", F.concat(F.lit(" FKs: "), F.col("fks"))).otherwise("")
    line = F.concat(F.lit("- "), F.col("table"), F.lit("("), F.col("cols"), F.lit(")"), key, fks)
    if samples is None:
        return shape.select("table", line.alias("line"))
    rows = samples.groupBy("table").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "row"))), lambda r: r["row"]), ", ").alias("rows"))
    return shape.join(rows, "table", "left").select("table", F.concat(line, F.coalesce(F.concat(F.lit(" Samples: ["), F.col("rows"), F.lit("]")), F.lit(""))).alias("line"))
