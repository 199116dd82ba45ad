"""Registry of named queries and their DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame`` reading the driver
tables; its oracle (optional) is ANSI SQL over the same tables registered
as views. Column names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: str | None
    covers: str


_REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, oracle, covers)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # importing the catalog modules fills the registry
    from mercato.plans import (  # noqa: F401
        catalog_clean,
        catalog_events,
        catalog_files,
        catalog_profile,
        catalog_reports,
        catalog_warehouse,
    )

    return dict(_REGISTRY)
