"""All registered queries."""

from __future__ import annotations

from . import queries_models, queries_pool, queries_tables  # noqa: F401
from .queries_tables import flagship
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "flagship"]
