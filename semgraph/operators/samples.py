"""Sample rows of tables, the same at any partitioning (OP-QGEN-DENSE, SRT-08)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import short_value
from .nodes import balanced_union


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """The md5 of the seed and the texts of the columns, each behind its length, null as ``-``."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def sample_rows(tables: Mapping[str, DataFrame], k: int = 2, keys: Mapping[str, Sequence[str]] | None = None, seed: int = 0, most: int = 80) -> DataFrame:
    """(table, place, hash, row): of every table the ``k`` rows whose keys have the smallest hashes, as JSON, in one plan.

    keys: the columns of a table that tell its rows apart (all, if not given).
    Rows of equal hash are ordered by their JSON.  Each partition keeps its own
    k smallest, so k small rows a partition and table are all that is moved;
    texts in a row are cut to ``most`` characters and ``...``.  Fewer rows
    give all of them, an empty table none; without tables it is an error.
    """
    if k < 1:
        raise ValueError("k is at least 1")

    def smallest(name: str, df: DataFrame) -> DataFrame:
        shown = [short_value(F.col(f"`{f.name}`"), most).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema]
        rows = df.select(row_hash((keys or {}).get(name) or df.columns, seed).alias("hash"), F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("row"))
        # One short list a table: its places follow from the list itself.
        ordered = rows.orderBy("hash", "row").limit(k).groupBy().agg(F.array_sort(F.collect_list(F.struct("hash", "row"))).alias("rows"))
        return ordered.select(F.lit(name).alias("table"), F.posexplode("rows").alias("p", "r")).select("table", (F.col("p") + 1).alias("place"), "r.hash", "r.row")

    return balanced_union([smallest(n, df) for n, df in tables.items()])
