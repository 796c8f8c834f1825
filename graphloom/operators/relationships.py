"""Relationship normalisation: adaptation of raw edges, alias lookup, stable ids, and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import names
from graphloom.operators.entities import last_of_name

ENTITY_PREFIX, RELATION_PREFIX = "graph:entity:", "graph:relation:"


def infer_parser(raw: DataFrame) -> DataFrame:
    """``parser`` from the shape of a raw edge, where ``source_parser`` is blank."""
    has = lambda c: F.col(c).isNotNull() if c in raw.columns else F.lit(False)
    java = has("relationship_type") & (has("package") | (F.col("file_path").endswith(".java") if "file_path" in raw.columns else F.lit(False)))
    shape = F.when(has("spec_source") | has("ref_path"), "openapi_parser").when(F.coalesce(java, F.lit(False)), "java_parser").when(has("predicate") | has("object_name"), "glm_triple_extractor").otherwise("unknown")
    given = names.first_non_blank("source_parser") if "source_parser" in raw.columns else F.lit(None).cast("string")
    return raw.withColumn("parser", F.coalesce(given, shape))


def normalise_relationships(raw: DataFrame, entities: DataFrame, entity_prefix: str = ENTITY_PREFIX, relation_prefix: str = RELATION_PREFIX) -> DataFrame:
    """``source``, ``target`` (entity ids, or the text where no entity has the name), ``type``, version 5 UUIDs of both
    ends and of the edge, and ``confidence``, from (``source``, ``target``, ``relation``, ``confidence``, ``pos``)."""
    # once a name, not once an edge; names are hashed in parts and edges pass by, so that edges of one name are never sorted
    index = last_of_name(entities).withColumn("uuid", names.uuid5(F.concat(F.lit(entity_prefix), "id")))
    out = raw.withColumn("s", F.lower("source")).withColumn("t", F.lower("target"))
    out = out.join(index.select(F.col("lower").alias("s"), F.col("id").alias("sid"), F.col("uuid").alias("su")).hint("shuffle_hash"), "s", "left").join(index.select(F.col("lower").alias("t"), F.col("id").alias("tid"), F.col("uuid").alias("tu")).hint("shuffle_hash"), "t", "left")
    out = out.withColumn("original_type", F.col("relation")).withColumn("type", names.canonical_relation(F.col("relation")))
    out = out.withColumn("source_id", F.coalesce("su", names.uuid5(F.concat(F.lit(entity_prefix), "source")))).withColumn("target_id", F.coalesce("tu", names.uuid5(F.concat(F.lit(entity_prefix), "target"))))
    out = out.withColumn("source", F.coalesce("sid", "source")).withColumn("target", F.coalesce("tid", "target")).drop("s", "t", "sid", "tid", "su", "tu", "relation")
    return out.withColumn("id", _edge_id(relation_prefix))


def _edge_id(relation_prefix: str):
    return names.uuid5(F.concat_ws(":", F.lit(relation_prefix.rstrip(":")), "source_id", "target_id", "type"))


def merge_edges(edges: DataFrame, entity_prefix: str = ENTITY_PREFIX, relation_prefix: str = RELATION_PREFIX) -> DataFrame:
    """One row per source, target and type: the most confident edge (the first of equals), all original types, and how
    many edges it stands for. UUIDs follow from the three, so they are made for merged edges only."""
    best = F.max_by("original_type", F.struct("confidence", -F.col("pos")))
    out = edges.groupBy("source", "target", "type").agg(best.alias("original_type"), F.max("confidence").alias("confidence"), F.array_sort(F.collect_set("original_type")).alias("original_types"), F.count("*").alias("n_provenance"))
    ends = {f"{end}_id": names.uuid5(F.concat(F.lit(entity_prefix), end)) for end in ("source", "target")}
    return out.withColumns(ends).withColumn("id", _edge_id(relation_prefix)).drop(*ends).select("id", *out.columns)


def existing_ends(edges: DataFrame, nodes: DataFrame, key: str = "id") -> DataFrame:
    """Edges both of whose ends are nodes."""
    ids = nodes.select(F.col(key).alias("__gl_id"))
    return edges.join(ids, edges["source"] == ids["__gl_id"], "left_semi").join(ids, edges["target"] == ids["__gl_id"], "left_semi")


def upsert(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """``new`` over ``old`` by key: columns that the new row leaves null keep the old value."""
    a, b = old.alias("a"), new.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    return both.select(*[F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) for c in old.columns])


def graph_statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Counts by kind and type, with totals where the type is null."""
    both = nodes.select(F.lit("node").alias("kind"), "type", "confidence").unionByName(edges.select(F.lit("edge").alias("kind"), "type", "confidence"))
    return both.rollup("kind", "type").agg(F.count("*").alias("n"), F.max("confidence").alias("max_confidence")).where("kind IS NOT NULL")
