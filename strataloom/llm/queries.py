"""The registered queries of this package and their oracle SQL."""

from __future__ import annotations

import importlib
import os
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(table)``, where ``table(name)`` reads a whole table, under ``name``."""
    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return fn(lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


def load_queries() -> None:
    """Import every ``queries_*`` module of this package, which registers its queries."""
    for module in pkgutil.iter_modules([os.path.dirname(__file__)]):
        if module.name.startswith("queries_"):
            importlib.import_module(f"{__package__}.{module.name}")
