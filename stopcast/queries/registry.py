"""Registry of named queries (one per inventory key) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle``
    is DuckDB SQL over the raw test tables with the same columns."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    # Import for side effects: each module registers its queries.
    from stopcast.queries import (  # noqa: F401
        q_history,
        q_etl,
        q_prep,
        q_eda,
        q_eval,
        q_ml,
        q_knn,
        q_features,
        q_models,
        q_stream,
        q_more,
    )
