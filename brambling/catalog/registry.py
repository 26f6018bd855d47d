"""Where the runnable queries and their DuckDB statements are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brambling.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under a name, with the statement that must give the same rows."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: build(Tables(spark, root))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap
