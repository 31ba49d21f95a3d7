"""Question sets (SRC-13, SRC-20, FLT-10, FLT-11, AGG-22, OP-QGEN, OP-FILTERQ, OP-PROMPT, OP-REFDIFF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import first_table, parse_sql
from .guard import judged

QUESTION = "question_id string, question string, notes string, reference_sql string, schema string"


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13: a JSON array of questions; blanks become null; an empty id or question is an error."""
    raw = spark.read.schema(QUESTION + ", _corrupt_record string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(path).cache()
    try:
        blank = lambda c: F.when(F.trim(c) != "", F.col(c))
        if raw.where(F.col("_corrupt_record").isNotNull()).limit(1).count():
            raise ValueError(f"{path} is no array of questions")
        clean = raw.select(*(blank(c).alias(c) for c in ("question_id", "question", "notes", "reference_sql", "schema")))
        if clean.where("question_id is null or question is null").limit(1).count():
            raise ValueError("a question lacks its id or text")
    finally:
        raw.unpersist()
    return clean


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-20: all ``batch_*.json`` of a folder; malformed files give no rows."""
    return spark.read.schema(QUESTION + ", shape string, sql string").option("multiLine", True).option("mode", "DROPMALFORMED").json(f"{folder}/batch_*.json")


def first_of_sql(questions: DataFrame, sql: str = "sql", order: list[str] | None = None) -> DataFrame:
    """AGG-22: of questions with the same SQL the first; surrounding white space doesn't count."""
    w = Window.partitionBy(F.trim(sql)).orderBy(*(order or ["question_id"]))
    return questions.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def filtered(questions: DataFrame, shapes_out: list[str], catalog: str) -> DataFrame:
    """OP-FILTERQ, FLT-08, FLT-10: unwanted shapes and unsafe SQL go, then copies; the schema is read off the SQL."""
    good = questions.where(~F.coalesce(F.col("shape").isin(shapes_out), F.lit(False))).withColumn("p", parse_sql("sql")).where("p.valid")
    good = good.withColumn("sql", F.col("p.sql")).drop("p")
    safe = good.join(judged(good, "sql", catalog).where("safe").select("sql"), "sql", "left_semi")
    return first_of_sql(safe.withColumn("schema", first_table("sql", 2)))


def trivial(n_rows: Column | str, n_columns: Column | str, cell: Column | str) -> Column:
    """FLT-11: one cell that is null, empty or zero; no rows are trivial too."""
    n_rows, n_columns, cell = (F.col(x) if isinstance(x, str) else x for x in (n_rows, n_columns, cell))
    return (n_rows == 0) | ((n_rows == 1) & (n_columns == 1) & (cell.isNull() | cell.cast("string").isin("", "0")))


def _schemas_named(schemas: list[str]) -> str:
    return f"schema '{schemas[0]}'" if len(schemas) == 1 else "schemas " + ", ".join(f"'{s}'" for s in schemas)


def prompts(questions: DataFrame, catalog: str, schemas: list[str], context: Column | None = None, heading: str = "Available tables and columns") -> DataFrame:
    """OP-PROMPT: (question_id, prompt) that asks for one SELECT, with or without context."""
    opening = f"Write one SQL SELECT that answers the question.\nThe data is in catalog '{catalog}', {_schemas_named(schemas)}.\n"
    rules = "Give only the SQL, with fully qualified names. Order rows only if asked to.\n\nQuestion: "
    middle = F.concat(F.lit(f"\n{heading}:\n"), F.coalesce(context, F.lit("")), F.lit("\n\n")) if context is not None else F.lit("")
    return questions.select("question_id", F.concat(F.lit(opening), middle, F.lit(rules), F.col("question")).alias("prompt"))


def batch_prompts(groups: DataFrame, lines: DataFrame, catalog: str, schema: str, wanted: int, over: int = 4) -> DataFrame:
    """OP-QGEN-DENSE: (seed, n_tables, prompt): for each group of connected tables (seed, table, depth) a prompt for ``over`` times the questions wanted.

    lines: (table, line) as ``dense.ddl_prompt`` gives them, nearest tables
    first.  Groups are a few tables each (``retrieve.subgraphs`` bounds them);
    a table without a line is left out, a group without any gives no prompt.
    """
    count = wanted * over
    body = groups.join(lines, "table").groupBy("seed").agg(F.count("*").alias("n_tables"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("depth", "table", "line"))), lambda r: r["line"]), "\n").alias("body"))
    opening = f"Tables of schema '{schema}' in catalog '{catalog}':\n"
    rules = f"\n\nWrite {count} questions with the SQL that answers each, as a JSON array of objects with question, shape and sql.\nShapes: join, aggregate, window; at least {max(1, count // 3)} of each.\nUse fully qualified names, join along the foreign keys, and filter by values that the samples show."
    return body.select("seed", "n_tables", F.concat(F.lit(opening), F.col("body"), F.lit(rules)).alias("prompt"))


def declared_in_ddl(ddl: DataFrame, text: str = "ddl") -> DataFrame:
    """OP-REFDIFF: (source_id, target_id) of single-column foreign keys written in ALTER TABLE statements."""
    pattern = r"(?is)alter\s+table\s+[`\w.-]+\s+add\s+constraint\s+[`\w-]+\s+foreign\s+key\s*\(\s*[`\w-]+\s*\)\s*references\s+[`\w.-]+\s*\(\s*[`\w-]+\s*\)"
    found = ddl.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("s"))
    take = lambda i: F.lower(F.replace(F.regexp_extract("s", r"(?is)alter\s+table\s+([`\w.-]+)\s.*?foreign\s+key\s*\(\s*([`\w-]+)\s*\)\s*references\s+([`\w.-]+)\s*\(\s*([`\w-]+)\s*\)", i), F.lit("`"), F.lit("")))
    return found.select(F.concat_ws(".", take(1), take(2)).alias("source_id"), F.concat_ws(".", take(3), take(4)).alias("target_id"))


def edge_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """SET-04: (source_id, target_id, kind): edges missing from the actual ones, and edges too many."""
    keys = ["source_id", "target_id"]
    missing = expected.select(*keys).join(actual.select(*keys), keys, "left_anti").withColumn("kind", F.lit("missing"))
    extra = actual.select(*keys).join(expected.select(*keys), keys, "left_anti").withColumn("kind", F.lit("extra"))
    return missing.unionByName(extra)
