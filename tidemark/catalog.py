"""Every runnable query with its SQL check, collected from the modules under ``queries``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load() -> None:
    """Import the query modules, which fills the registry."""
    from tidemark.queries import (  # noqa: F401
        drift,
        evaluation,
        exploration,
        features,
        models,
        monitoring,
        quality,
        runs,
        sketches,
        sources,
        splits,
        store,
    )
