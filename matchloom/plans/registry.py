"""Named queries and the DuckDB statement each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchloom.plans.oracle_views import check_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function under ``name``."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = check_sql(sql)
        return function

    return register


def load() -> None:
    """Import the catalogue, which fills the two dictionaries."""
    from matchloom.plans import catalogue  # noqa: F401
