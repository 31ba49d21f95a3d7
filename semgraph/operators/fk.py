"""Foreign keys, declared and inferred (OP-PKGATE, OP-FKINFER, OP-FKDECL, OP-FK).

Name matching is an equi-join on link keys: ``E|name`` for the same name and
``S|stem`` for a name less its suffix against a table's name, so candidates are
found by hashing and never by comparing all pairs of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import dotted_id
from .nodes import columns_frame, references

# Confidence by kind of name match, key evidence, and whether comments share a word.
SCORES = [
    ("exact", "declared_pk", True, 0.95),
    ("exact", "declared_pk", False, 0.90),
    ("exact", "unique_or_heur", True, 0.88),
    ("exact", "unique_or_heur", False, 0.83),
    ("suffix", "declared_pk", True, 0.88),
    ("suffix", "declared_pk", False, 0.83),
    ("suffix", "unique_or_heur", True, 0.82),
    ("suffix", "unique_or_heur", False, 0.78),
]
# Endings that a referring column's name may have.
SUFFIXES = ("_id", "_fk", "_ref")


def pk_gate(frame: DataFrame, constraints: DataFrame, whole: bool = False) -> DataFrame:
    """OP-PKGATE: (col_id, pk_evidence) of columns that may be referred to; ``whole``: with the columns of the frame that infer() reads.

    In order of precedence: the only column of a declared primary key; the
    first of a unique constraint; a column ``id``; ``{table}_id`` where the
    table has one ``_id`` column.  Keys are told apart by table as well as name.
    """
    by = ["table_catalog", "table_schema", "table_name", "constraint_name"]
    declared = constraints.where("constraint_type = 'PRIMARY KEY'").groupBy(*by).agg(F.first("column_name").alias("column_name"), F.count("*").alias("n")).where("n = 1")
    key = dotted_id("table_catalog", "table_schema", "table_name", "column_name").alias("col_id")
    name, table = F.lower("column_name"), F.lower("table_name")
    # Counts alone are grouped by hash; the few names that qualify are looked up.
    named = name == F.concat(table, F.lit("_id"))
    alone = frame.where(name.endswith("_id")).groupBy("table_key").agg(F.count("*").alias("n"), F.count(F.when(named, 1)).alias("m")).where("n = 1 and m = 1")
    own = frame.where(named).select("table_key", "col_id").join(alone, "table_key", "left_semi")
    unique = constraints.where("constraint_type = 'UNIQUE' and ordinal_position = 1").select(key).unionAll(own.select("col_id"))
    marks = declared.select(key, F.lit(0).alias("mark")).unionAll(unique.withColumn("mark", F.lit(1))).groupBy("col_id").agg(F.min("mark").alias("mark"))
    evidence = F.when(F.col("mark") == 0, "declared_pk").when((F.col("mark") == 1) | (name == "id"), "unique_or_heur")
    read = frame.select("table_catalog", "table_schema", "table_name", "column_name", "col_id", "canon", "tokens")
    gated = read.join(marks, "col_id", "left").withColumn("pk_evidence", evidence).where("pk_evidence is not null").drop("mark")
    return gated if whole else gated.select("col_id", "pk_evidence")


def composite_keys(constraints: DataFrame) -> DataFrame:
    """AGG-04: how many declared primary keys have more than one column."""
    return constraints.where("constraint_type = 'PRIMARY KEY'").groupBy("table_catalog", "table_schema", "table_name", "constraint_name").count().where("count > 1").agg(F.count("*").alias("composite_pks"))


def candidates(frame: DataFrame, gate: DataFrame | None = None) -> DataFrame:
    """JOIN-01, WIN-01: the best name match of each ordered pair of columns of one canonical type within a schema.

    gate: (col_id, pk_evidence) of the columns that may be referred to; others
    are dropped before the join, so a name that every table has makes no pairs
    unless it is a key.  Two columns ``id`` are no pair, so they get no key for
    the same name: with one, all tables' ids would meet all others.
    """
    s, t = _sides(frame, gate)
    on = F.col("s_col_id") != F.col("t_col_id")
    for c in LINK:
        on &= F.col(f"s_{c}") == F.col(f"t_{c}")
    best = Window.partitionBy("s_col_id", "t_col_id").orderBy(F.when(F.col("s_kind") == "exact", 0).otherwise(1))
    return s.join(t, on).withColumn("rn", F.row_number().over(best)).where("rn = 1").drop("rn")


#: What agrees between two columns of a pair; the key, which tells most apart, is compared first when rows are sorted.
LINK = ("key", "canon", "table_schema", "table_catalog")


def _sides(frame: DataFrame, gate: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The columns under each of their link keys, as referring ones (s_) and as those referred to (t_)."""
    name, table = F.lower("column_name"), F.lower("table_name")
    # A name has one of the suffixes at most.
    stem = F.coalesce(*(F.when(name.endswith(x) & (F.length(name) > len(x)), F.expr(f"substring(lower(column_name), 1, length(column_name) - {len(x)})")) for x in SUFFIXES))
    is_id = name == "id"
    same = F.when(~is_id, F.concat(F.lit("E|"), name))
    less = [F.when(is_id & table.endswith(e) & (F.length(table) > len(e)), F.concat(F.lit("S|"), F.expr(f"substring(lower(table_name), 1, length(table_name) - {len(e)})"))) for e in ("s", "es")]
    source_keys = F.array(same, F.concat(F.lit("S|"), stem))
    target_keys = F.array(same, F.when(is_id, F.concat(F.lit("S|"), table)), *less)

    def side(some: DataFrame, keys: Column, p: str, *more: str) -> DataFrame:
        named = some.select(*(F.col(c).alias(f"{p}_{c}") for c in ("table_catalog", "table_schema", "col_id", "canon", "tokens")), *more, F.explode(keys).alias(f"{p}_key")).where(F.col(f"{p}_key").isNotNull())
        return named.withColumn(f"{p}_kind", F.when(F.startswith(f"{p}_key", F.lit("E|")), "exact").otherwise("suffix"))

    if gate is None:
        return side(frame, source_keys, "s"), side(frame, target_keys, "t")
    targets = gate if "canon" in gate.columns else frame.join(gate, "col_id")
    return side(frame, source_keys, "s"), side(targets, target_keys, "t", "pk_evidence")


def infer(frame: DataFrame, gate: DataFrame, declared: DataFrame | None = None, threshold: float = 0.8) -> DataFrame:
    """OP-FKINFER: REFERENCES edges from names, types, key evidence and comments.

    A source with n edges above the threshold has each divided by
    sqrt(n - 1), if that is over 1, and loses those that then fall below it.
    """
    # A source with more edges than this loses all, whatever their scores; so no more targets of a key are joined than tell so.
    most = max(2, int(1 + (max(x for *_, x in SCORES) / threshold) ** 2)) if threshold > 0 else 2**31 - 3
    s, t = _sides(frame, gate)

    def score(commented: bool) -> Column:
        cases = [(F.col("t_kind") == kind) & (F.col("pk_evidence") == evidence) for kind, evidence, c, _ in SCORES if c == commented]
        return F.coalesce(*(F.when(case, x) for case, x in zip(cases, [x for *_, c, x in SCORES if c == commented], strict=True)))

    t = t.withColumns({"t_plain": score(False), "t_commented": score(True)}).where(F.greatest("t_plain", "t_commented") >= threshold)
    # Targets whose score is enough without a common word count for every source of their key, so the first ones by id decide.
    nth = F.dense_rank().over(Window.partitionBy(*(f"t_{c}" for c in LINK)).orderBy("t_col_id"))
    sure = t.where(F.least("t_plain", "t_commented") >= threshold).withColumn("nth", nth).where(F.col("nth") <= most + 2)
    grouped = sure.groupBy(*(f"t_{c}" for c in LINK)).agg(F.max("nth").alias("n"), F.collect_list(F.struct("t_col_id", "t_tokens", "t_plain", "t_commented")).alias("some"))
    grouped = grouped.select(*(f"t_{c}" for c in LINK), "n", F.when(F.col("n") <= most + 1, F.col("some")).alias("some"))
    # The others are few: they need a common word.  By name alone there are at most three of a key.
    unsure = t.where(F.least("t_plain", "t_commented") < threshold)
    unsure = unsure.select(*(f"t_{c}" for c in LINK), F.lit(1).alias("n"), F.array(F.struct("t_col_id", "t_tokens", "t_plain", "t_commented")).alias("some"))
    on = F.lit(True)
    for c in LINK:
        on &= F.col(f"s_{c}") == F.col(f"t_{c}")
    # One target more than may be is too many but for a source that is among them; a source that is lost takes no targets along.
    lost = (F.col("n") > most) & ~F.coalesce(F.array_contains("some.t_col_id", F.col("s_col_id")), F.lit(False))
    met = s.join(grouped.unionAll(unsure), on).select("s_col_id", "s_tokens", (F.col("s_kind") == "exact").alias("exact"), F.explode_outer(F.when(~lost, F.col("some"))).alias("t"))
    shared = F.coalesce(F.arrays_overlap("s_tokens", "t.t_tokens"), F.lit(False))
    scored = met.select("s_col_id", F.col("t.t_col_id").alias("t_col_id"), "exact", F.when(shared, F.col("t.t_commented")).otherwise(F.col("t.t_plain")).alias("score"))
    scored = scored.where(F.col("t_col_id").isNull() | ((F.col("t_col_id") != F.col("s_col_id")) & (F.col("score") >= threshold)))
    # Of a pair the match of the same name counts; a source that is lost by one key is lost.
    pairs = scored.repartition("s_col_id").groupBy("s_col_id", "t_col_id").agg(F.max(F.when(F.col("exact"), F.col("score"))).alias("best"), F.max("score").alias("score"))
    of = Window.partitionBy("s_col_id")
    pairs = pairs.select("s_col_id", "t_col_id", F.coalesce("best", "score").alias("score"), F.count("t_col_id").over(of).alias("n"), F.count("*").over(of).alias("rows"))
    pairs = pairs.where((F.col("n") == F.col("rows")) & (F.col("n") <= most))
    spread = F.col("score") / F.greatest(F.lit(1.0), F.sqrt(F.col("n") - 1))
    edges = pairs.withColumn("confidence", spread).where(F.col("confidence") >= threshold)
    edges = edges.select(F.col("s_col_id").alias("source_id"), F.col("t_col_id").alias("target_id"), F.round("confidence", 4).alias("confidence"), F.lit("inferred_metadata").alias("source"), F.lit(None).cast("string").alias("criteria"))
    return references(edges if declared is None else edges.join(declared.select("source_id", "target_id"), ["source_id", "target_id"], "left_anti"))


def declared(pairs: DataFrame, schemas: list[str] | None = None) -> DataFrame:
    """OP-FKDECL: REFERENCES edges of declared foreign keys, confidence 1; both ends must be in scope."""
    if schemas:
        pairs = pairs.where(F.col("fk_schema").isin(schemas) & F.col("tgt_schema").isin(schemas))
    ends = (dotted_id(*(f"{s}_{c}" for c in ("catalog", "schema", "table", "column"))).alias(n) for s, n in (("src", "source_id"), ("tgt", "target_id")))
    return references(pairs.select(*ends, F.lit(1.0).alias("confidence"), F.lit("declared").alias("source"), F.lit(None).cast("string").alias("criteria")))


def accounting(constraints: DataFrame, pairs: DataFrame) -> DataFrame:
    """AGG-10: declared constraints, those resolved to columns (by catalog, schema and name), those not, and edges."""
    total = constraints.select("constraint_catalog", "constraint_schema", "constraint_name").distinct().agg(F.count("*").alias("fk_declared"))
    found = pairs.agg(F.count_distinct("src_catalog", "fk_schema", "fk_name").alias("fk_resolved"), F.count("*").alias("fk_edges"))
    return total.crossJoin(found).select("fk_declared", "fk_resolved", (F.col("fk_declared") - F.col("fk_resolved")).alias("fk_skipped"), "fk_edges")


def unresolved(constraints: DataFrame, pairs: DataFrame) -> DataFrame:
    """JOIN-08: declared constraints without a resolved pair, by catalog, schema and name."""
    found = pairs.select(F.col("src_catalog").alias("constraint_catalog"), F.col("fk_schema").alias("constraint_schema"), F.col("fk_name").alias("constraint_name")).distinct()
    return constraints.join(found, found.columns, "left_anti")


def discover(columns: DataFrame, constraints: DataFrame, pairs: DataFrame | None = None, threshold: float = 0.8, max_columns: int = 0) -> DataFrame:
    """OP-FK: declared edges and inferred ones beside them; nothing is inferred beyond ``max_columns`` columns (0: no limit)."""
    spark = columns.sparkSession
    known = declared(pairs) if pairs is not None else spark.createDataFrame([], "source_id string, target_id string, confidence double, source string, criteria string")
    if max_columns and columns.count() > max_columns:
        return references(known)
    frame = columns_frame(columns)
    return references(known).unionByName(infer(frame, pk_gate(frame, constraints, whole=True), known, threshold))
