"""Registry of runnable queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from phenoloom.plans.views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan over ``Tables`` under ``name``."""

    def register(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return plan

    return register
