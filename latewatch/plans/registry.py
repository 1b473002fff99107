"""Registry of catalogue queries: key -> (Spark query, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str | None]] = {}


def register(name: str, oracle: str | None):
    """Decorator: add ``fn`` under ``name`` with its oracle SQL (``None`` = rows-only)."""
    def deco(fn: Query) -> Query:
        if name in CATALOG:
            raise ValueError(f"duplicate query key {name}")
        CATALOG[name] = (fn, oracle)
        return fn
    return deco
