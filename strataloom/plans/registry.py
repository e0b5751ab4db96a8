"""Registry of runnable queries: name -> (callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy readers of the Parquet tables in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle SQL."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap
