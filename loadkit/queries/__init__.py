"""Queries over the given tables, each with the SQL that states its expected result.

The SQL never repeats the operator: where text is damaged on purpose, it derives the expected value
from the row's own columns. Remainders of a key choose which damage a row gets, never which rows are
read: every query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadkit.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

Tables = Callable[[str], DataFrame]


def query(name: str, sql: str | None = None):
    """Register a function of (table reader, session) as a query."""

    def keep(function: Callable[[Tables, SparkSession], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return function(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), spark)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


from loadkit.queries import loads, repairs, scalars, tables  # noqa: E402,F401
