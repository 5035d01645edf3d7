"""Registry of named queries and their DuckDB oracle SQL.

Conventions for comparable results: every computed column is aliased with the
same name on both sides, counts are BIGINT, doubles are rounded to 6 places.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None: rows-only check)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r6(c) -> F.Column:
    """Round a double column to 6 places (both sides of the oracle do)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
