"""Registry of named queries (Spark callables) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` as ``name``; ``sql`` is the
    independent SQL text computing the same rows (None: rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that the registry is filled."""
    from tabtext.plans import (  # noqa: F401
        q_text, q_relational, q_stats, q_encode, q_matrix, q_sampling, q_metrics, q_models,
    )
