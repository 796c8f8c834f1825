"""Sinks: bundles, extraction records, graph artefacts, and a graph store of node and edge tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.names import safe_name
from graphloom.operators.relationships import existing_ends, upsert

PROVENANCE = ("repository", "module", "document", "file_path", "version_tag", "source_parser")


def write_bundles(rows: DataFrame, path: str, by: tuple[str, ...]) -> None:
    """JSON files in a folder for each value of the columns, whose names are made safe for paths. Only folders that the
    rows have are replaced."""
    for c in by:
        rows = rows.withColumn(c, safe_name(F.col(c)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def append_records(rows: DataFrame, path: str, keep_failed: bool = True, vectors: bool = True) -> None:
    """Extraction records as JSON lines; failed ones and vectors (but not their length) may be left out."""
    if not keep_failed:
        rows = rows.where(F.coalesce("llm_status", F.lit("success")) != "failed")
    if "vector" in rows.columns:
        rows = rows.withColumn("dimension", F.size("vector"))
        rows = rows if vectors else rows.drop("vector")
    rows.write.mode("append").json(path)


def store_properties(entities: DataFrame) -> DataFrame:
    """``id``, ``type``, ``aliases``, ``confidence``, a sorted list of distinct values for each provenance field, and the
    sources as JSON. ``sources`` is an array of structs."""
    lists = [F.array_sort(F.array_distinct(F.filter(F.col(f"sources.{c}"), lambda v: F.coalesce(F.trim(v) != "", F.lit(False))))).alias(c) for c in PROVENANCE]
    return entities.select("id", "type", "aliases", "confidence", *lists, F.to_json("sources").alias("provenance"))


def write_artefacts(path: str, entities: DataFrame, deduplicated: DataFrame, edges: DataFrame, summary: DataFrame, statistics: DataFrame, report: DataFrame) -> None:
    """The six results of a run, each a folder of JSON."""
    named = {"canonical_entities": entities, "deduplicated_entities": deduplicated, "normalized_relationships": edges, "graph_import_summary": summary, "graph_statistics": statistics, "pipeline_report": report}
    for name, rows in named.items():
        rows.write.mode("overwrite").json(f"{path}/{name}")


def write_graph(spark: SparkSession, path: str, nodes: DataFrame, edges: DataFrame, version: str) -> dict[str, int]:
    """Upsert nodes and then the edges whose ends exist; a new version of the tables is written beside the old one.

    Returns how many were asked for and are in the store. Ids must be unique.
    """
    for rows, what in ((nodes, "node"), (edges, "edge")):
        if not rows.groupBy("id").count().where("count > 1").isEmpty():
            raise ValueError(f"an id names more than one {what}")
    before = _current(spark, path)
    if before:
        nodes = upsert(spark.read.parquet(f"{path}/{before}/nodes"), nodes)
    nodes.write.parquet(f"{path}/{version}/nodes")
    nodes = spark.read.parquet(f"{path}/{version}/nodes")
    wanted = edges.count()
    edges = existing_ends(edges, nodes)
    if before:
        edges = upsert(spark.read.parquet(f"{path}/{before}/edges"), edges)
    edges.write.parquet(f"{path}/{version}/edges")
    spark.createDataFrame([(version,)], "version string").write.mode("append").json(f"{path}/versions")
    return {"requested_edges": wanted, "nodes": nodes.count(), "edges": spark.read.parquet(f"{path}/{version}/edges").count()}


def _current(spark: SparkSession, path: str) -> str | None:
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return None
    parts = F.regexp_extract_all("version", F.lit(r"(\d+|\D+)"), F.lit(1))
    natural = F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p))  # v10 comes after v9
    return spark.read.schema("version string").json(f"{path}/versions").agg(F.max_by("version", natural)).first()[0]


def write_changed(rows: DataFrame, old: DataFrame, key: str, write: Callable[[DataFrame], None]) -> None:
    """Write only rows whose content differs from what is there."""
    mark = lambda df: df.select(key, F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256).alias("__gl_hash"))
    changed = mark(rows).join(mark(old), [key, "__gl_hash"], "left_anti")
    write(rows.join(changed.select(key), key, "left_semi"))
