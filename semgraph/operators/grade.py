"""Grading of result sets and summaries of evaluation arms (OP-COMPARE, AGG-16, AGG-17, SET-05, WIN-04)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cell_text
from ..sources.shared import own_folder
from .nodes import balanced_union
from .running import ranged, running_totals
from .store import delete

# Rows from which sampling replaces full comparison, the shortfall allowed then, and the share of the sample that must match.
LARGE_ROWS, LARGE_SHORTFALL, LARGE_MATCH = 500, 0.10, 0.80
SAMPLE, EXTRA_COLUMNS = 50, 4


def normal_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(row, n): each row as the sorted texts of its cells, with how often it occurs; column order and names don't matter."""
    cells = F.array_sort(F.array(*(cell_text(F.col(f"`{c}`")) for c in columns or df.columns)))
    return df.select(cells.alias("row")).groupBy("row").agg(F.count("*").alias("n"))


def project_to(generated: DataFrame, reference: DataFrame) -> DataFrame:
    """The generated columns that bear the reference's names, if all of them are there."""
    names = {c.lower(): c for c in generated.columns}
    wanted = [c.lower() for c in reference.columns]
    return generated.select(*(names[c] for c in wanted)) if len(generated.columns) > len(wanted) and all(c in names for c in wanted) else generated


def differences(generated: DataFrame, reference: DataFrame) -> DataFrame:
    """One row: rows of each side, rows of the reference missing (by multiset), and rows too many."""
    g, r = generated.withColumnRenamed("n", "gn"), reference.withColumnRenamed("n", "rn")
    both = g.join(r, "row", "full")
    gn, rn = F.coalesce("gn", F.lit(0)), F.coalesce("rn", F.lit(0))
    return both.agg(F.coalesce(F.sum(gn), F.lit(0)).alias("n_gen"), F.coalesce(F.sum(rn), F.lit(0)).alias("n_ref"), F.coalesce(F.sum(F.greatest(rn - gn, F.lit(0))), F.lit(0)).alias("missing"), F.coalesce(F.sum(F.greatest(gn - rn, F.lit(0))), F.lit(0)).alias("extra"))


def _tagged(name: str, generated: DataFrame, reference: DataFrame) -> list[DataFrame]:
    """(pair, variant, row, gn, rn) of both sides: variant 0 is the comparison itself, the others are choices of so many generated columns as the reference has.

    Choices count only below 500 rows a side, so they are made of 500 rows at most.
    """
    generated = project_to(generated, reference)
    width = len(reference.columns)

    def side(df: DataFrame, variant: Column, row: Column, ours: bool) -> DataFrame:
        return df.select(F.lit(name).alias("pair"), variant.alias("variant"), row.alias("row"), F.lit(int(ours)).alias("gn"), F.lit(int(not ours)).alias("rn"))

    def cells(columns: list[str]) -> Column:
        return F.array_sort(F.array(*(cell_text(F.col(f"`{c}`")) for c in columns)))

    def plain(df: DataFrame) -> DataFrame:
        return df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # names may occur twice

    generated, reference = plain(generated), plain(reference)
    frames = [side(generated, F.lit(0), cells(generated.columns), True), side(reference, F.lit(0), cells(reference.columns), False)]
    if 0 < len(generated.columns) - width <= EXTRA_COLUMNS:
        chosen = list(combinations(generated.columns, width))
        tried = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), cells(list(c)).alias("r")) for i, c in enumerate(chosen, 1))))
        frames.append(side(generated.limit(LARGE_ROWS).select(tried.alias("t")), F.col("t.i"), F.col("t.r"), True))
        frames.append(side(reference.limit(LARGE_ROWS).select(cells(reference.columns).alias("r"), F.explode(F.sequence(F.lit(1), F.lit(len(chosen)))).alias("i")), F.col("i"), F.col("r"), False))
    return frames


def graded(pairs: Mapping[str, tuple[DataFrame, DataFrame]], folder: str | None = None) -> DataFrame:
    """OP-COMPARE: (pair, correct, reason): whether each generated result answers as its reference does, and why not.

    pairs: from a name to (generated, reference).  The rows of all pairs are
    counted in one plan, in ranges that are written once (to ``folder``), and
    all verdicts come from those; nothing reaches the driver.  From 500 rows on
    either side: too short by over a tenth fails, a larger multiset that holds
    the reference passes, else four fifths of a stride sample must match
    (WIN-04: every stride-th of the sorted rows, 50 at most, at the stride that
    the generated side gives).  Below: equal multisets, or equal after dropping
    up to four extra columns.  Two empty results are equal; no pairs are an error.
    """
    frames = [f for name, (g, r) in pairs.items() for f in _tagged(name, g, r)]
    counts = balanced_union(frames).groupBy("pair", "variant", "row").agg(F.sum("gn").alias("gn"), F.sum("rn").alias("rn"))
    dealt = ranged(counts, ["pair", "variant", "row"], folder)
    by_variant = dealt.groupBy("pair", "variant").agg(F.sum("gn").alias("g"), F.sum("rn").alias("r"), F.sum(F.greatest(F.col("rn") - F.col("gn"), F.lit(0))).alias("missing"), F.sum(F.greatest(F.col("gn") - F.col("rn"), F.lit(0))).alias("extra"))
    main = F.col("variant") == 0
    value = lambda c: F.coalesce(F.max(F.when(main, F.col(c))), F.lit(0)).alias(c)
    sums = by_variant.groupBy("pair").agg(value("g"), value("r"), value("missing"), value("extra"), F.coalesce(F.bool_or(~main & (F.col("missing") + F.col("extra") == 0)), F.lit(False)).alias("subset"))

    large = F.greatest("g", "r") >= LARGE_ROWS
    short = (F.col("g") < F.col("r")) & ((F.col("r") - F.col("g")) / F.col("r") > LARGE_SHORTFALL)
    holds = ((F.col("g") > F.col("r")) & (F.col("missing") == 0)) | (F.col("g") == 0)
    size = F.least(F.lit(SAMPLE), F.col("g"))
    stride = F.greatest(F.lit(1), F.floor(F.col("g") / F.greatest(size, F.lit(1))))
    # Only pairs that are still open are sampled.
    opened = sums.where(large & ~short & ~holds).select("pair", size.alias("size"), stride.alias("stride"))
    rows = running_totals(dealt.where("variant = 0").join(opened, "pair"), "row", {"gn": "gu", "rn": "ru"}, ["pair"])
    first = F.greatest(F.ceil((F.col("gu") - F.col("gn")) / F.col("stride")), F.ceil((F.col("ru") - F.col("rn")) / F.col("stride")))
    last = F.least(F.floor((F.col("gu") - 1) / F.col("stride")), F.floor((F.col("ru") - 1) / F.col("stride")), F.col("size") - 1)
    # A row stands at the sampled places that its spans on both sides share.
    same = rows.where("gn > 0 and rn > 0").groupBy("pair").agg((F.sum(F.greatest(last - first + 1, F.lit(0))) / F.max("size")).alias("rate"))

    names = dealt.sparkSession.createDataFrame([(n,) for n in pairs], "pair string")
    every = names.join(sums, "pair", "left").join(same, "pair", "left").fillna(0, ["g", "r", "missing", "extra", "rate"]).fillna(False, ["subset"])
    reason = (
        F.when(large & short, F.format_string("row count divergence >10%% below reference: generated=%d reference=%d", "g", "r"))
        .when(large & (holds | (F.col("rate") >= LARGE_MATCH)), None)
        .when(large, F.format_string(f"sampled match rate %.1f%% < {LARGE_MATCH:.0%}%", F.col("rate") * 100))
        .when(F.col("g") != F.col("r"), F.format_string("row count mismatch: generated=%d reference=%d", "g", "r"))
        .when((F.col("missing") + F.col("extra") == 0) | F.col("subset"), None)
        .otherwise("result set values differ")
    )
    return every.select("pair", reason.alias("reason")).select("pair", F.col("reason").isNull().alias("correct"), "reason")


def compare(generated: DataFrame, reference: DataFrame) -> tuple[bool, str | None]:
    """OP-COMPARE of one pair; what ``graded`` writes for it is removed."""
    spark = generated.sparkSession
    folder = own_folder(spark, "graded")
    try:
        row = graded({"": (generated, reference)}, folder).first()
    finally:
        delete(spark, folder)
    return row["correct"], row["reason"]


def arm_summary(results: DataFrame) -> DataFrame:
    """AGG-16: counts and rates of each arm; rates are of attempted questions, correct_rate of gradable ones."""
    flags = ["parsed", "executed", "non_empty", "correct"]
    sums = results.groupBy("arm").agg(F.count("*").alias("attempted"), *(F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags), F.count("correct").alias("gradable"))

    def rate(a: str, b: str) -> Column:
        return F.round(F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)), 3)

    return sums.withColumns({"parse_rate": rate("parsed", "attempted"), "execution_rate": rate("executed", "attempted"), "non_empty_rate": rate("non_empty", "executed"), "correct_rate": rate("correct", "gradable")})
