"""How a plan module names its queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f: Callable[[SparkSession, str], DataFrame]):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add
