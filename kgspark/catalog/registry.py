"""Where catalog modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kgspark.sources.driver import Driver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(driver)`` under ``name``, with the equivalent SQL if there is one."""
    from kgspark.catalog.twins import with_views

    def add(fn: Callable[[Driver], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Driver(spark, sf_dir))

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return add
