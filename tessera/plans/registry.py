"""Query registry: key -> (spark, sf_dir) -> DataFrame, plus the DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: ``@register("agg_mrr", sql=...)``.  ``sql=None`` means the
    operator is checked rows-only by the driver (and by brute force in tests)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tessera.plans import (  # noqa: F401
        graph_queries,
        io_queries,
        ml_queries,
        relational_queries,
        request_queries,
        retrieval_queries,
        stream_queries,
        text_queries,
        triple_queries,
    )
