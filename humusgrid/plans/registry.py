"""Registration of named queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from humusgrid.sources.tables import load_table


class Tables:
    """Tables of a dataset folder by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load_table(self.spark, self._dir, name)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracle: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        """Register a function of the dataset's tables under its name."""

        def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            self.queries[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
            if sql:
                self.oracle[fn.__name__] = sql
            return fn

        return wrap
