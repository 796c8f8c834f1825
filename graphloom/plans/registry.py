"""All registered queries with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.plans import extract, java, markdown, normalise, openapi, whole

MODULES = (normalise, markdown, openapi, java, extract, whole)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
