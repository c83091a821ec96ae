"""Registry of named queries: Spark callables and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import oracle
from tidemark.plans.gold import MODEL_NAMES, Build

Query = Callable[[SparkSession, str], DataFrame]


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Build(spark, sf_dir), name)
    run.__name__ = name
    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _model(name) for name in MODEL_NAMES}
    from tidemark.plans import operator_queries, sink_queries  # noqa: F401  (sink_queries adds its own to them)
    out.update(operator_queries.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = {name: oracle.sql_for(name) for name in MODEL_NAMES}
    from tidemark.plans import operator_queries, sink_queries  # noqa: F401
    out.update(operator_queries.ORACLE)
    return out
