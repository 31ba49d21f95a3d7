"""Retrieval of a schema subgraph for questions (GRF-01..16, VEC-01..06, FTX-01, RET-01..10 but for business terms, OP-SELSCHEMA, OP-RENDER, OP-METRICS).

All operators take many questions at once; each frame carries ``question_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import dotted_id, schema_of
from ..functions.text import question_tokens, short_value
from . import fulltext, vectorindex


def _doubles(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Raw cosine of two vectors, in doubles."""
    a, b = _doubles(a), _doubles(b)
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def cosine_topk(queries: DataFrame, items: DataFrame, k: int, within: list[str] | None = None, apart: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """VEC-01, VEC-06: (question_id, id, score, rank), the k nearest items of each query, ties to the smaller id.

    queries: (question_id, vector, ...); an index by cells is built for the
    search (see vectorindex, where one can be stored).  within: columns that must
    agree, joined on before scoring.  apart: an item whose id is the query's is
    none of its own.  keep: the items' columns to return (without ``within``).
    Rows without a usable vector take no part.
    """
    if within:
        return vectorindex.within(queries, items, within, k, apart)
    return vectorindex.topk(queries, vectorindex.build(items.select("id", "vector", *keep)), k, apart, keep)


def cosine_candidates(queries: DataFrame, candidates: DataFrame, items: DataFrame) -> DataFrame:
    """VEC-02: scores of named candidates only; 0 where an item has no vector."""
    known = candidates.join(items.select("id", F.col("vector").alias("_v")), "id", "left").join(queries.select("question_id", "vector"), "question_id")
    return known.select("question_id", "id", F.round(F.coalesce(cosine("vector", "_v"), F.lit(0.0)), 6).alias("score"))


def _undirected(refs: DataFrame, threshold: float) -> DataFrame:
    kept = refs.where(F.coalesce("confidence", F.lit(1.0)) >= threshold).select("source_id", "target_id", F.coalesce("confidence", F.lit(1.0)).alias("confidence"))
    return kept.select(F.col("source_id").alias("col_id"), F.col("target_id").alias("far_id"), "confidence").union(kept.select("target_id", "source_id", "confidence"))


def parent_tables(seeds: DataFrame, has_column: DataFrame) -> DataFrame:
    """GRF-01: tables of seed columns."""
    return seeds.join(has_column, seeds["id"] == has_column["target_id"]).select("question_id", F.col("source_id").alias("table_id")).distinct()


def joined_columns(seeds: DataFrame, refs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """GRF-06: columns at the far end of the seeds' edges."""
    return seeds.join(_undirected(refs, threshold), seeds["id"] == F.col("col_id")).select("question_id", F.col("far_id").alias("id")).distinct()


def expanded_tables(seeds: DataFrame, refs: DataFrame, has_column: DataFrame, threshold: float = 0.8) -> DataFrame:
    """GRF-02, GRF-03, AGG-12: tables one edge from a seed column, with their highest confidence."""
    far = seeds.join(_undirected(refs, threshold), seeds["id"] == F.col("col_id")).select("question_id", F.col("far_id"), "confidence")
    tables = far.join(has_column, far["far_id"] == has_column["target_id"]).select("question_id", F.col("source_id").alias("table_id"), "confidence")
    return tables.groupBy("question_id", "table_id").agg(F.max("confidence").alias("max_conf"))


def ranked_tables(expanded: DataFrame, cosines: DataFrame, alpha: float = 0.5, most: int = 0) -> DataFrame:
    """GRF-04, SRT-04, MTH-03: by alpha * confidence + (1 - alpha) * cosine, at most ``most`` a question (0: all)."""
    both = expanded.join(cosines.select("question_id", F.col("id").alias("table_id"), F.col("score").alias("cos")), ["question_id", "table_id"], "left")
    score = F.round(alpha * F.col("max_conf") + (1 - alpha) * F.coalesce("cos", F.lit(0.0)), 6)
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "table_id")
    ranked = both.withColumn("score", score).withColumn("rank", F.row_number().over(order))
    return (ranked.where(F.col("rank") <= most) if most > 0 else ranked).select("question_id", "table_id", "score", "rank")


def join_lines(seeds: DataFrame, refs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """GRF-05: join predicates of edges at a seed, with provenance; ``source = target`` where none is stored."""
    kept = refs.where(F.coalesce("confidence", F.lit(1.0)) >= threshold)
    either = seeds.join(kept, (seeds["id"] == F.col("source_id"))).unionByName(seeds.join(kept, (seeds["id"] == F.col("target_id"))))
    predicate = F.coalesce("criteria", F.concat_ws(" = ", "source_id", "target_id"))
    return either.select("question_id", predicate.alias("predicate"), F.coalesce("source", F.lit("declared")).alias("source"), F.coalesce("confidence", F.lit(1.0)).alias("confidence")).distinct()


def lexical_tables(questions: DataFrame, tables: DataFrame) -> DataFrame:
    """GRF-09, GRF-10, JOIN-14: items whose name contains a word of the question.

    A word has three letters or more, so a name that contains it has its first
    three as one of its own triples: an equality join finds those, and only they
    are searched for the word.
    """
    tokens = questions.select("question_id", F.explode(question_tokens("question")).alias("token")).withColumn("_t", F.substring("token", 1, 3))
    n = F.col("_n")
    names = tables.select("id", F.lower("name").alias("_n")).where(F.length(n) >= 3)
    triples = names.select("id", "_n", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(n) - 2), lambda i: F.substr(n, i, F.lit(3))))).alias("_t"))
    return tokens.join(triples, "_t").where(F.contains(n, F.col("token"))).select("question_id", "id").distinct()


def ordered_union(parts: list[DataFrame]) -> DataFrame:
    """SET-03: (question_id, id, place) of id lists after one another, first occurrences only; parts hold ``rank``."""
    tagged = [p.select("question_id", "id", F.lit(n).alias("part"), F.col("rank").cast("long").alias("rank")) for n, p in enumerate(parts)]
    whole = tagged[0]
    for t in tagged[1:]:
        whole = whole.unionByName(t)
    first = whole.groupBy("question_id", "id").agg(F.min(F.struct("part", "rank")).alias("at"))
    order = Window.partitionBy("question_id").orderBy("at", "id")
    return first.select("question_id", "id", F.row_number().over(order).alias("place"))


def select_schemas(column_seeds: DataFrame, table_seeds: DataFrame, runner_up: float = 0.20) -> DataFrame:
    """OP-SELSCHEMA, AGG-13, SRT-05: the best schema, and the next if its share is ``runner_up`` or more.

    Seed scores are summed by schema and made shares within each index, added,
    and made shares again; ties go to the smaller name.
    """
    seeds = [df.select("question_id", "id", "score", F.lit(n).alias("index")) for n, df in enumerate((column_seeds, table_seeds))]
    return schemas_of(seeds[0].unionByName(seeds[1]), runner_up)


def schemas_of(seeds: DataFrame, runner_up: float = 0.20) -> DataFrame:
    """As select_schemas(), of the seeds of all indexes as one frame (question_id, index, id, score), which is computed once."""
    raw = seeds.withColumn("schema", schema_of("id")).where("schema is not null").groupBy("question_id", "index", "schema").agg(F.sum("score").alias("s"))
    shares = raw.withColumn("s", F.coalesce(F.try_divide("s", F.sum("s").over(Window.partitionBy("question_id", "index"))), F.lit(0.0)))
    both = shares.groupBy("question_id", "schema").agg(F.sum("s").alias("s"))
    part = Window.partitionBy("question_id")
    shared = both.withColumn("share", F.round(F.try_divide("s", F.sum("s").over(part)), 6))
    ranked = shared.withColumn("rank", F.row_number().over(part.orderBy(F.desc("share"), "schema")))
    return ranked.where((F.col("rank") == 1) | ((F.col("rank") == 2) & (F.col("share") >= runner_up))).select("question_id", "schema", "share", "rank")


def true_schema_names(chosen: DataFrame, schemas: DataFrame) -> DataFrame:
    """JOIN-13: ``chosen`` with the schemas' own names in place of the parts of ids, which are lower case; a part that no Schema node has stays."""
    names = schemas.select(F.lower("name").alias("schema"), F.col("name").alias("_true")).groupBy("schema").agg(F.min("_true").alias("_true"))
    return chosen.join(names, "schema", "left").withColumn("schema", F.coalesce("_true", "schema")).select(*chosen.columns)


def fetch_columns(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """GRF-07, SRT-03: columns of the tables, with quoted names."""
    c = columns.withColumn("table_id", dotted_id("catalog", "schema", "table")).withColumn("table_fqn", F.concat_ws(".", *(F.concat(F.lit("`"), F.col(p), F.lit("`")) for p in ("catalog", "schema", "table"))))
    return tables.join(c, "table_id").select("question_id", "table_id", "table_fqn", F.col("id").alias("column_id"), F.col("name").alias("column_name"), "data_type", F.coalesce("comment", F.lit("")).alias("comment"), "ordinal_position")


def fetch_values(columns: DataFrame, has_value: DataFrame, values: DataFrame, each: int = 20, chars: int = 80, total: int = 2000) -> DataFrame:
    """GRF-08, LIM-01: sampled values of columns: so many of each, so many characters of one, so many of a question."""
    v = columns.join(has_value, columns["column_id"] == has_value["source_id"]).join(values.select(F.col("id").alias("target_id"), "value", "count"), "target_id")
    by_column = Window.partitionBy("question_id", "column_id").orderBy(F.desc("count"), "value")
    by_question = Window.partitionBy("question_id").orderBy("column_id", "rank")
    ranked = v.withColumn("rank", F.row_number().over(by_column)).where(F.col("rank") <= each).withColumn("nth", F.row_number().over(by_question)).where(F.col("nth") <= total)
    return ranked.select("question_id", "column_id", short_value("value", chars).alias("value"), "rank")


def _joined(rows: Column, separator: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r.getField("line")), separator)


def render(columns: DataFrame, lines: DataFrame, values: DataFrame, schemas: DataFrame, per_column: int = 10) -> DataFrame:
    """OP-RENDER: (question_id, text): the sections Target schema, Tables, Joins, Sample values."""
    suffix = F.when(F.col("comment") != "", F.concat(F.lit(" — "), F.col("comment"))).otherwise("")
    line = F.concat(F.lit("  "), F.col("column_name"), F.lit(" ("), F.col("data_type"), F.lit(")"), suffix)
    tables = columns.groupBy("question_id", "table_fqn").agg(_joined(F.struct("ordinal_position", "column_name", line.alias("line")), "\n").alias("body"))
    tables = tables.groupBy("question_id").agg(_joined(F.struct("table_fqn", F.concat(F.lit("Table: "), F.col("table_fqn"), F.lit("\n"), F.col("body")).alias("line")), "\n\n").alias("tables"))
    note = F.concat(F.lit("  "), F.col("predicate"), F.lit("  ["), F.col("source"), F.lit(", conf="), F.format_string("%.2f", F.col("confidence")), F.lit("]"))
    joins = lines.groupBy("question_id").agg(_joined(F.struct("predicate", "source", note.alias("line")), "\n").alias("joins"))
    shown = values.where(F.col("rank") <= per_column).groupBy("question_id", "column_id").agg(_joined(F.struct("rank", F.col("value").alias("line")), ", ").alias("vals")).join(columns.select("question_id", "column_id", "column_name", "table_fqn"), ["question_id", "column_id"])
    samples = shown.groupBy("question_id").agg(_joined(F.struct("column_id", F.concat(F.lit("  "), F.col("column_name"), F.lit(" ("), F.col("table_fqn"), F.lit("): "), F.col("vals")).alias("line")), "\n").alias("samples"))
    chosen = schemas.groupBy("question_id").agg(_joined(F.struct("rank", F.col("schema").alias("line")), ", ").alias("chosen"))
    whole = tables.join(chosen, "question_id", "left").join(joins, "question_id", "left").join(samples, "question_id", "left")
    text = F.concat(
        F.coalesce(F.concat(F.lit("Target schema: "), F.col("chosen"), F.lit("\n\n")), F.lit("")),
        F.lit("Tables:\n"), F.col("tables"),
        F.coalesce(F.concat(F.lit("\n\nJoins:\n"), F.col("joins")), F.lit("")),
        F.coalesce(F.concat(F.lit("\n\nSample values:\n"), F.col("samples")), F.lit("")),
    )
    return whole.select("question_id", text.alias("text"))


def metrics(traces: DataFrame) -> DataFrame:
    """OP-METRICS: from (question_id, target_schema, top_schema, chosen array, column_ids array); null without a target."""
    target = F.col("target_schema")
    from_target = F.size(F.filter("column_ids", lambda c: schema_of(c) == target)).cast("double")
    has = target.isNotNull()
    return traces.select(
        "question_id",
        F.when(has, F.col("top_schema") == target).alias("top1_schema_match"),
        F.when(has, F.array_contains("chosen", target)).alias("schema_in_context"),
        F.when(has & (F.size("column_ids") > 0), F.round(from_target / F.size("column_ids"), 6)).alias("context_purity"),
    )


def fulltext_topk(queries: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """FTX-01: documents by the summed tf * idf of the query's words, through an impact-ordered index; ties to the smaller id."""
    return fulltext.topk(queries, documents, k)


def hybrid(vector: DataFrame, text: DataFrame, k: int, constant: int = 60) -> DataFrame:
    """RET: ranks of two strategies fused: the sum of 1 / (constant + rank)."""
    both = vector.select("question_id", "id", "rank").unionByName(text.select("question_id", "id", "rank"))
    fused = both.groupBy("question_id", "id").agg(F.round(F.sum(F.lit(1.0) / (constant + F.col("rank"))), 8).alias("score"))
    best = Window.partitionBy("question_id").orderBy(F.desc("score"), "id")
    return fused.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def two_stage_topk(queries: DataFrame, schemas: DataFrame, tables: DataFrame, n_schemas: int, k: int) -> DataFrame:
    """RET, schema then table: the k nearest tables of each query within its ``n_schemas`` nearest schemas.

    schemas: (id, vector); tables: (id, vector, schema), schema being a schema's id.
    """
    chosen = cosine_topk(queries, schemas, n_schemas).select("question_id", F.col("id").alias("schema"))
    asked = queries.select("question_id", "vector").join(chosen, "question_id")
    return cosine_topk(asked, tables, k, within=["schema"])


def by_table(ranked: DataFrame, has_column: DataFrame | None, k: int) -> DataFrame:
    """RET, column level: from ranked columns (question_id, id, score) the k tables with the best column, ties to the smaller id.

    has_column: None if ``ranked`` has the tables already, as source_id.
    """
    owned = ranked if has_column is None else ranked.join(has_column.select("source_id", F.col("target_id").alias("id")), "id")
    best = owned.groupBy("question_id", F.col("source_id").alias("id")).agg(F.max("score").alias("score"))
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def strategy_matrix(ranked: dict[str, DataFrame]) -> DataFrame:
    """RET-10: a row for each item with its rank by each strategy, its best rank and in how many it occurs."""
    parts = [df.groupBy("id").agg(F.min("rank").alias("rank")).withColumn("strategy", F.lit(name)) for name, df in ranked.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    wide = whole.groupBy("id").pivot("strategy", list(ranked)).agg(F.min("rank"))
    extra = whole.groupBy("id").agg(F.min("rank").alias("best_rank"), F.count("*").alias("coverage"))
    return wide.join(extra, "id")


def schema_dump(columns: DataFrame, most: int = 7500) -> DataFrame:
    """GRF-11, STR-13: (text): all tables with their columns, cut at a line's end before ``most`` characters (0: whole)."""
    suffix = F.when(F.coalesce("comment", F.lit("")) != "", F.concat(F.lit(" — "), F.col("comment"))).otherwise("")
    line = F.concat(F.lit("  "), F.col("name"), F.lit(" ("), F.col("data_type"), F.lit(")"), suffix)
    fqn = F.concat_ws(".", "catalog", "schema", "table")
    tables = columns.groupBy(fqn.alias("fqn")).agg(_joined(F.struct("ordinal_position", "name", line.alias("line")), "\n").alias("body"))
    whole = tables.agg(_joined(F.struct("fqn", F.concat(F.lit("Table: "), F.col("fqn"), F.lit("\n"), F.col("body")).alias("line")), "\n\n").alias("text"))
    if most <= 0:
        return whole
    note = F.concat(F.lit(f"\n[schema truncated at {most} chars; "), F.length("text").cast("string"), F.lit(" total]"))
    # The last line's end among the first ``most`` characters.
    upto = F.lit(most) - F.instr(F.reverse(F.substring("text", 1, most)), "\n")
    return whole.select(F.when(F.length("text") > most, F.concat(F.left("text", upto), note)).otherwise(F.col("text")).alias("text"))


def fk_list(refs: DataFrame) -> DataFrame:
    """GRF-12: (left_id, right_id) of edges, each unordered pair once."""
    return refs.select(F.least("source_id", "target_id").alias("left_id"), F.greatest("source_id", "target_id").alias("right_id")).distinct()


def value_lists(has_value: DataFrame, values: DataFrame) -> DataFrame:
    """GRF-13, AGG-14: (column_id, vals): the distinct values of each column in order."""
    both = has_value.join(values.select(F.col("id").alias("target_id"), "value"), "target_id")
    return both.groupBy(F.col("source_id").alias("column_id")).agg(F.array_join(F.array_sort(F.collect_set("value")), ", ").alias("vals"))


def table_graph(refs: DataFrame, has_column: DataFrame) -> DataFrame:
    """GRF-14: (a, b) of tables joined by an edge, both ways, without loops."""
    s = has_column.select(F.col("target_id").alias("source_id"), F.col("source_id").alias("a"))
    t = has_column.select("target_id", F.col("source_id").alias("b"))
    pairs = refs.select("source_id", "target_id").join(s, "source_id").join(t, "target_id").select("a", "b").where("a <> b")
    return pairs.union(pairs.select("b", "a")).distinct()


def subgraphs(seeds: DataFrame, graph: DataFrame, depth: int = 2, most: int = 8, least: int = 3) -> DataFrame:
    """GRF-15: (seed, table_id, depth) of tables within ``depth`` steps, nearest first and then by name, at most ``most``; groups below ``least`` go."""
    reached = seeds.select(F.col("table_id").alias("seed"), "table_id", F.lit(0).alias("depth"))
    front = reached
    for d in range(1, depth + 1):
        front = front.join(graph, front["table_id"] == graph["a"]).select("seed", F.col("b").alias("table_id"), F.lit(d).alias("depth")).distinct()
        reached = reached.unionByName(front)
    nearest = reached.groupBy("seed", "table_id").agg(F.min("depth").alias("depth"))
    part = Window.partitionBy("seed")
    ranked = nearest.withColumn("rn", F.row_number().over(part.orderBy("depth", "table_id"))).where(F.col("rn") <= most)
    return ranked.withColumn("n", F.count("*").over(part)).where(F.col("n") >= least).select("seed", "table_id", "depth")
