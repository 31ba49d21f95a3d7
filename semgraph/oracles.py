"""SQL that queries equal, beside which they are registered."""

from __future__ import annotations

from . import queries as _queries  # noqa: F401
from .registry import ORACLES


def oracle_sql() -> dict:
    return dict(ORACLES)
