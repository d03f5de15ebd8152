"""A list of named queries with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Book:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a query under its function's name, with or without SQL."""

        def register(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql is not None:
                self.oracles[f.__name__] = sql
            return f

        return register
