"""Registration of queries: each is a function (spark, folder) -> DataFrame, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None):
        """A query over tables: the function gets a Tables and returns a DataFrame."""

        def add(f):
            key = name or f.__name__
            self.queries[key] = lambda spark, folder: f(Tables(spark, folder))
            if sql:
                self.sql[key] = sql
            return f

        return add


class Tables:
    """Tables of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
