"""Queries of the whole graph pipeline over parts and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.plans import pipeline
from graphloom.plans.base import rows
from graphloom.plans.normalise import NAMES

EDGES = """SELECT l_orderkey * 8 + l_linenumber AS pos, p_name AS source, p_type AS target, CASE l_linenumber WHEN 1 THEN 'calls' WHEN 2 THEN 'dependsOn' ELSE 'documents' END AS relation, l_discount AS confidence
FROM @lineitem JOIN @part ON p_partkey = l_partkey"""


def graph(spark, d):
    return pipeline.build(rows(spark, d, NAMES), rows(spark, d, EDGES))


QUERIES = {
    "graph_pipeline_nodes": lambda spark, d: graph(spark, d).nodes.withColumn("aliases", F.array_join("aliases", "|")).withColumn("members", F.array_join("members", "|")),
    "graph_pipeline_edges": lambda spark, d: graph(spark, d).edges.withColumn("original_types", F.array_join("original_types", "|")),
    "graph_pipeline_stats": lambda spark, d: graph(spark, d).statistics,
}
ORACLES: dict[str, str] = {}
