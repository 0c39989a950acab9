"""Registered queries of the trace engine: each applies an operator to a whole table, with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import emit_queries, field_queries, merge_queries, observer_queries, relation_queries, scalar_queries, stored_queries, submission_queries, temporal_queries

_MODULES = (temporal_queries, merge_queries, relation_queries, scalar_queries, stored_queries, observer_queries, emit_queries, submission_queries, field_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.QUERIES.sql.items()}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each purchase the last view's value before it: the flagship as-of lookup."""
    return queries()["asof_backward"](spark, sf_dir)
