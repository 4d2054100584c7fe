"""Registered queries: each applies an operator to the given tables.

``@query(name, sql)`` registers a callable (spark, sf_dir) -> DataFrame and, where SQL can say
the same, the SQL text over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_FUNCTIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_MODULES = ["reviews", "web", "listings", "lookups", "summaries", "numbers", "cards", "art",
            "folders", "streams"]


def query(name: str, sql: str | None = None):
    def register(function):
        if name in _FUNCTIONS:
            raise ValueError(f"query registered twice: {name}")
        _FUNCTIONS[name] = function
        if sql:
            _SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Narrow rows of a table in one small file, dealt to all cores before pages are made of them."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _load() -> None:
    for module in _MODULES:
        import_module(f"{__name__}.{module}")


def functions() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_FUNCTIONS)


def sql_texts() -> dict[str, str]:
    _load()
    return dict(_SQL)
