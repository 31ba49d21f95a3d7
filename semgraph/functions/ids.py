"""Identifier expressions (PRJ-01, PRJ-02, FLT-06, FLT-07)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def dotted_id(*parts: Column | str) -> Column:
    """PRJ-01: lower-cased parts joined by dots; null parts are left out and nothing else is folded."""
    return F.lower(F.concat_ws(".", *parts))


def value_id(column_id: Column | str, value: Column | str) -> Column:
    """PRJ-02: the column's id, a dot, and the md5 of the value as a string."""
    column_id, value = (F.col(x) if isinstance(x, str) else x for x in (column_id, value))
    return F.concat(column_id, F.lit("."), F.md5(value.cast("string")))


def id_part(node_id: Column | str, place: int) -> Column:
    """Catalog (1) or schema (2) of an id of three pieces or more; null for a shorter one."""
    pieces = F.split(node_id, r"\.")
    return F.when(F.size(pieces) >= 3, F.element_at(pieces, place))


def schema_of(node_id: Column | str) -> Column:
    return id_part(node_id, 2)


def catalog_of(node_id: Column | str) -> Column:
    return id_part(node_id, 1)


def in_catalogs(node_id: Column | str, catalogs: list[str]) -> Column:
    """FLT-06: the id is one of the catalogs or lies below one."""
    node_id = F.col(node_id) if isinstance(node_id, str) else node_id
    return reduce(lambda a, b: a | b, [(node_id == c.lower()) | node_id.startswith(c.lower() + ".") for c in catalogs], F.lit(False))


def in_schemas(node_id: Column | str, schemas: list[str]) -> Column:
    """FLT-07: the id's schema is one of ``schemas``; an empty list lets all pass."""
    return schema_of(node_id).isin([s.lower() for s in schemas]) if schemas else F.lit(True)
