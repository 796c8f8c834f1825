"""Queries and SQL of the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import chat_format, decontamination, embedding_dedup, language_id, licences, packing, sharding, simhash, substring_dedup, suffix_dedup

MODULES = (substring_dedup, language_id, licences, packing, simhash, decontamination, chat_format, suffix_dedup, sharding, embedding_dedup)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql() if callable(sql) else sql for m in MODULES for name, sql in m.ORACLES.items()}
