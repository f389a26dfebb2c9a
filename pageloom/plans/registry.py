"""Where queries put themselves by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_MODULES = ("diary", "archive", "ordered", "lookups", "documents", "scalars", "graph", "resolution", "extract", "curation", "answers", "nearby")


def query(sql: str | None = None):
    """Registers a query, with its SQL if SQL can say it."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def load() -> tuple[dict, dict]:
    for module in _MODULES:
        import_module(f"{__package__}.{module}")
    return QUERIES, SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
