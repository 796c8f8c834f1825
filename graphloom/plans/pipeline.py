"""The whole way from parsed entities and edges to a canonical graph with statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.checkpoints import checkpoint
from graphloom.operators import entities, relationships


@dataclass(frozen=True)
class Graph:
    canonical: DataFrame
    nodes: DataFrame
    edges: DataFrame
    statistics: DataFrame


def build(raw_entities: DataFrame, raw_edges: DataFrame, rules: tuple = (entities.exact_alias_links, entities.domain_links, entities.similar_name_links, entities.cosine_links)) -> Graph:
    """Canonicalise and merge entities, deduplicate them by the rules' links, normalise and merge edges.

    ``raw_entities`` have name, type, source_parser, confidence and pos; ``raw_edges`` source, target, relation,
    confidence and pos; entities may have an ``embedding``. A rule takes entities and returns (left, right, score, reason).
    Canonical entities and nodes, which all later steps read, are written to the shared checkpoint folder.
    """
    canonical = checkpoint(entities.merge(entities.canonicalise(raw_entities)).withColumnRenamed("canonical_id", "id"))
    links = None
    for rule in rules:
        found = rule(canonical)
        links = found if links is None else links.union(found)
    nodes = canonical if links is None else checkpoint(entities.deduplicate(canonical, links))
    index = nodes.withColumn("pos", F.xxhash64("id"))
    edges = relationships.merge_edges(relationships.normalise_relationships(raw_edges, index))
    return Graph(canonical, nodes, edges, relationships.graph_statistics(nodes, edges))
