"""All registered queries of the core engine, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern import queries as _tables
from lectern import queries_runs, queries_sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _tables.queries() | queries_sql.QUERIES | queries_runs.QUERIES


def oracle_sql() -> dict[str, str]:
    return _tables.oracle_sql() | queries_sql.SQL | queries_runs.SQL
