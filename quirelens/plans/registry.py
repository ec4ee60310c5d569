"""The queries by key, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register the decorated (spark, sf_dir) -> DataFrame under ``key``."""

    def register(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = make
        if sql is not None:
            CHECKS[key] = sql
        return make

    return register
