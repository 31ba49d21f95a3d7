"""All queries of the engine over the tables of a directory."""

from __future__ import annotations

from .plans import queries_catalog, queries_data, queries_embed, queries_features, queries_graph, queries_runs, queries_sql  # noqa: F401  they register themselves
from .registry import QUERIES


def queries() -> dict:
    return dict(QUERIES)
