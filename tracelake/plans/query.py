"""A family of named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Family:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable:
        """Register a function of a table reader under its name: ``read(name)`` gives a table."""

        def register(f: Callable) -> Callable:
            self.queries[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register
