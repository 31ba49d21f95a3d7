"""Line dedup by overlapping three-line windows, in native DataFrame operations.

Every three consecutive lines of a text are hashed together.  A window that
occurs more than once in all texts is kept where it occurs first, by (doc_id,
text hash, position); each later occurrence covers its three lines, overlapping
occurrences merge, and covered lines go.

Plan: one pass makes 128-bit window hashes (no text is shuffled for them); a
pre-aggregated count by hash finds repeated ones and their first place; a join
marks later occurrences, whose sides Spark splits where a hash is hot
(spark.sql.adaptive.skewJoin must be on for that, as it is by default); only
the marks are grouped by document and joined to the texts.

``passages`` adds windows of one and two lines, where they hold more than
LONG words or are a whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines that one window spans.
WINDOW = 3
#: In front of what is hashed a second time.
SEED = 1
#: Words that a passage of fewer lines must exceed.
LONG = 50


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row.

    A plain projection would be pulled into the lambdas that use the column and
    then computed for each of their elements; a generator isn't.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _window_hashes(df: DataFrame, text: str, widths: tuple[int, ...]) -> tuple[DataFrame, Column]:
    """``df`` with line hashes, and a column of (_pos, _hash, _more, _width) for each run of lines of the given widths.

    Left out are runs where no line holds a word, and runs of fewer lines than
    WINDOW that are neither long nor the whole text.
    """
    df = _once(df, "_lines", F.split(F.col(text), "\n", -1))
    spaced = lambda x: F.translate(x, "\t\r\x0b\x0c", "    ")
    # Two hashes of 64 bits with different seeds, of lines and of windows.
    solid = F.transform("_lines", lambda x: F.when(F.trim(spaced(x)) != "", F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(SEED), x).alias("b"))))
    df = df.where(F.size("_lines") >= min(widths))
    if min(widths) < WINDOW:
        df = _once(df, "_words", F.transform("_lines", lambda x: F.size(F.filter(F.split(spaced(x), " "), lambda w: w != ""))))
    df = _once(df, "_hashes", solid).drop("_lines", text)
    blank = F.lit(0).cast("long")

    def runs(width: int) -> Column:
        def one(i: Column) -> Column:
            own = [F.element_at("_hashes", i + k + 1) for k in range(width)]
            counted = F.coalesce(*own).isNotNull()
            if width < WINDOW:
                counted &= (F.size("_hashes") == width) | (sum((F.element_at("_words", i + k + 1) for k in range(width)), F.lit(0)) > LONG)
            key = [F.xxhash64(*(F.coalesce(x[half], blank) for x in own), F.lit(width)) for half in ("a", "b")]
            return F.when(counted, F.struct(i.cast("int").alias("_pos"), key[0].alias("_hash"), key[1].alias("_more"), F.lit(width).alias("_width")))

        return F.transform(F.when(F.size("_hashes") >= width, F.sequence(F.lit(0), F.size("_hashes") - width)).otherwise(F.array().cast("array<int>")), one)

    return df, F.array_compact(F.concat(*(runs(w) for w in widths)))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", passages: bool = False) -> DataFrame:
    """``docs`` with ``text`` cleaned and ``n_lines``, ``n_removed`` added (replacing columns of that name).

    Lines are the pieces between ``\\n``.  A text of fewer than three lines has
    no window and stays (unless ``passages`` is set), as do windows of blank lines only.  A null text stays
    null with 0 lines.  Rows equal in key and text are one document: what goes
    from one goes from all, and their first occurrences stay in all.  A null
    key sorts first, and an empty table gives an empty one.
    """
    keyed = docs.drop("n_lines", "n_removed").withColumn("_th", F.xxhash64(F.col(text)))
    hashed, runs = _window_hashes(keyed.select(F.col(key).alias("_key"), "_th", text), text, (1, 2, WINDOW) if passages else (WINDOW,))
    spots = hashed.select("_key", "_th", F.explode(runs).alias("_run")).select("_key", "_th", "_run.*")
    place = F.struct("_key", "_th", "_pos")
    # Rows of one document are counted once: several equal rows alone repeat nothing.
    repeated = spots.groupBy("_hash", "_more").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where(F.col("_first") != F.col("_last"))
    same = (F.col("_hash") == F.col("_h")) & (F.col("_more") == F.col("_m"))
    later = spots.join(repeated.select(F.col("_hash").alias("_h"), F.col("_more").alias("_m"), "_first"), same).where(place != F.col("_first"))
    marks = later.groupBy("_key", "_th").agg(F.collect_set(F.struct("_pos", "_width")).alias("_starts")).withColumnsRenamed({"_key": "_mk", "_th": "_mt"})
    joined = keyed.join(marks, F.col(key).eqNullSafe(F.col("_mk")) & (F.col("_th") == F.col("_mt")), "left")
    joined = _once(joined, "_lines", F.split(F.col(text), "\n", -1))
    covered = F.array_distinct(F.flatten(F.transform("_starts", lambda p: F.sequence(p["_pos"], p["_pos"] + p["_width"] - 1))))
    joined = _once(joined, "_covered", covered)
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_covered"))
    clean = F.when(F.col("_starts").isNull(), F.col(text)).otherwise(F.array_join(F.transform(left, lambda i: F.element_at("_lines", i + 1)), "\n"))
    return joined.select(
        *(clean.alias(text) if c == text else F.col(c) for c in keyed.columns if c != "_th"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_covered"), F.lit(0)).cast("long").alias("n_removed"),
    )
