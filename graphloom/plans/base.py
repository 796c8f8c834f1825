"""Inputs of the registered queries: SQL that Spark and DuckDB both read, over the driver's tables.

``@name`` stands for a table. What an operator computes from an input is written twice, as column functions here and
as SQL of the other engine in the oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_NAMED = re.compile(rf"@({'|'.join(TABLES)})\b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows(spark: SparkSession, sf_dir: str, sql: str, **dealt: str) -> DataFrame:
    """Run shared input SQL on Spark. Tables named in ``dealt`` are dealt to all cores by that key first: a scan of few
    splits may make texts of many times its size, and windows by the key then move no text."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in set(_NAMED.findall(sql)):
        read = table(spark, sf_dir, name)
        (read.repartition(width, dealt[name]) if name in dealt else read).createOrReplaceTempView(f"graphloom_{name}")
    return spark.sql(_NAMED.sub(r"graphloom_\1", sql))


def duck(sql: str) -> str:
    """The same input SQL for the oracle."""
    return _NAMED.sub(r"\1", sql)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def duck_map(table: dict[str, str], key: str) -> str:
    """A lookup as CASE, null where there is none."""
    return f"CASE {key} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items()) + " END"
