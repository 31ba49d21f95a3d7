"""Keys and references that the rows of tables bear out, for catalogs that declare none (SRC-04, SRC-05).

Candidates are tested exactly: one grouping a candidate key, one anti-join a
candidate reference.  The candidates that hold are written to the shared folder, a
small row each, so that what is made of them tests nothing anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.nodes import balanced_union
from .shared import own_folder


def _name(prefix: str, name: str, columns: list[str]) -> str:
    return f"{prefix}_{name}__{'_'.join(columns)}"


def _kept(held: DataFrame) -> DataFrame:
    folder = own_folder(held.sparkSession, "found")
    held.coalesce(1).write.parquet(folder)
    return held.sparkSession.read.schema(held.schema).parquet(folder)


def _usage(held: DataFrame, extra: Column) -> DataFrame:
    """A row for each column of (constraint_catalog, constraint_schema, constraint_name, table_name, columns)."""
    one = held.select("constraint_catalog", "constraint_schema", "constraint_name", F.col("constraint_catalog").alias("table_catalog"), F.col("constraint_schema").alias("table_schema"), "table_name", F.posexplode("columns").alias("i", "column_name"))
    return one.withColumns({"ordinal_position": F.col("i") + 1, "position_in_unique_constraint": extra}).drop("i")


def keys(tables: dict[str, DataFrame], candidates: dict[str, list[list[str]]], catalog: str = "lake", schema: str = "main") -> tuple[DataFrame, DataFrame]:
    """(table constraints, key column usage) of the candidates in whose columns no row has a null and no two rows agree.

    Of a table's candidates that hold the first is its primary key, the others
    are unique constraints.  A table without rows has all of its candidates.
    """

    def tested(name: str, place: int, columns: list[str]) -> DataFrame:
        own = [F.col(c).alias(f"v{i}") for i, c in enumerate(columns)]
        null = reduce(lambda a, b: a | b, (F.col(f"v{i}").isNull() for i in range(len(columns))))
        groups = tables[name].select(*own).groupBy(*(f"v{i}" for i in range(len(columns)))).agg(F.count("*").alias("n"))
        fits = groups.agg((F.coalesce(F.max("n"), F.lit(1)) == 1).alias("single"), (F.count_if(null) == 0).alias("full"))
        return fits.where("single and full").select(F.lit(name).alias("table_name"), F.lit(place).alias("place"), F.array(*map(F.lit, columns)).alias("columns"), F.lit(_name("key", name, columns)).alias("constraint_name"))

    held = _kept(balanced_union([tested(n, i, cs) for n, some in candidates.items() for i, cs in enumerate(some)]))
    held = held.withColumns({"constraint_catalog": F.lit(catalog), "constraint_schema": F.lit(schema)})
    nth = F.row_number().over(Window.partitionBy("table_name").orderBy("place"))
    constraints = held.select("constraint_catalog", "constraint_schema", "constraint_name", F.when(nth == 1, "PRIMARY KEY").otherwise("UNIQUE").alias("constraint_type"))
    return constraints, _usage(held, F.lit(None).cast("int"))


def references(tables: dict[str, DataFrame], candidates: list[tuple[str, list[str], str, list[str]]], catalog: str = "lake", schema: str = "main") -> tuple[DataFrame, DataFrame]:
    """(referential constraints, key column usage) of (child, columns, parent, referred columns) of which all values are there.

    A child's row with a null among the columns refers to nothing, so it
    breaks no reference.  Each refers to the parent's key of these columns by
    the name that ``keys`` gives it, whether it is a key or not.
    """

    def tested(child: str, columns: list[str], parent: str, referred: list[str]) -> DataFrame:
        own = tables[child].select(*(F.col(c).alias(f"v{i}") for i, c in enumerate(columns))).dropna().distinct()
        there = tables[parent].select(*(F.col(c).alias(f"v{i}") for i, c in enumerate(referred)))
        lost = own.join(there, own.columns, "left_anti").agg(F.count("*").alias("n"))
        return lost.where("n = 0").select(F.lit(child).alias("table_name"), F.array(*map(F.lit, columns)).alias("columns"), F.lit(_name("ref", child, columns) + f"__{parent}").alias("constraint_name"), F.lit(_name("key", parent, referred)).alias("unique_constraint_name"))

    held = _kept(balanced_union([tested(*c) for c in candidates]))
    held = held.withColumns({f"{u}constraint_{x}": F.lit(v) for u in ("", "unique_") for x, v in (("catalog", catalog), ("schema", schema))})
    return held.drop("table_name", "columns"), _usage(held, F.col("i") + 1)
