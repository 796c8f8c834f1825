"""Scans: text files, bundles and records as rows. Paths are Spark's, so any file system it reads will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.names import first_non_blank, strip
from graphloom.operators.openapi import yaml_to_json

BUNDLE = """entities array<map<string,string>>, relationships array<map<string,string>>, documents array<struct<document_id:string,text:string,source_parser:string,source_metadata:map<string,string>,provenance:map<string,string>>>,
  source_metadata array<map<string,string>>, provenance map<string,string>, version_metadata map<string,string>, _broken string"""
RECORD = "source_id string, source_parser string, entities array<map<string,string>>, spacy_entities array<map<string,string>>, llm_entities array<map<string,string>>, relationships array<map<string,string>>, triples array<map<string,string>>, document_chunks array<struct<text:string,label:string>>, chunks array<struct<text:string,label:string>>, llm_status string, _broken string"


def _relative(root: str) -> Column:
    return F.regexp_replace(F.substring_index(F.col("path"), root.rstrip("/") + "/", -1), "%20", " ")


def text_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``path`` (below the root) and ``text`` of files; bytes that aren't UTF-8 become replacement characters."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).load(root)
    return raw.select(_relative(root).alias("path"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def documents(spark: SparkSession, root: str, parser: str, patterns: tuple[str, ...]) -> DataFrame:
    """Files of any of the patterns, each once, as documents named by parser and path."""
    pattern = patterns[0] if len(patterns) == 1 else "{" + ",".join(patterns) + "}"
    return text_files(spark, root, pattern).select(F.concat_ws(":", F.lit(parser), "path").alias("document_id"), "text", F.lit(parser).alias("source_parser"), "path")


def markdown_documents(spark: SparkSession, root: str) -> DataFrame:
    """Markdown files of one directory; ``stem`` without the mark of cleaned files."""
    out = text_files(spark, root, "*.md", recursive=False)
    return out.select("path", F.regexp_replace(F.regexp_replace("path", r"\.md$", ""), "_clean$", "").alias("stem"), "text")


def specifications(spark: SparkSession, root: str) -> DataFrame:
    """API specifications in YAML or JSON as ``spec`` (the path) and JSON ``text``; what can't be read, or has no info, goes."""
    out = text_files(spark, root).where(F.lower("path").rlike(r"\.(ya?ml|json)$"))
    return out.select(F.col("path").alias("spec"), yaml_to_json("text").alias("text")).where("get_json_object(text, '$.info') IS NOT NULL")


def java_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of repositories, one directory each below the root."""
    out = text_files(spark, root)
    return out.select(F.substring_index("path", "/", 1).alias("repository"), F.regexp_replace("path", "^[^/]+/", "").alias("path"), "text")


def bundles(spark: SparkSession, root: str) -> DataFrame:
    """JSON bundles, broken files left out; missing parts are empty."""
    raw = spark.read.schema(BUNDLE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(root)
    raw = raw.where("_broken IS NULL").drop("_broken")
    return raw.select(*[F.coalesce(c, F.array().cast(raw.schema[c].dataType)).alias(c) if t.startswith("array") else F.col(c) for c, t in raw.dtypes])


def bundle_documents(found: DataFrame) -> DataFrame:
    """Documents of bundles, each id once, with what kind of source they are from."""
    d = found.select(F.inline("documents")).where("document_id IS NOT NULL").dropDuplicates(["document_id"])
    return d.withColumn("source_type", F.when(F.col("source_parser") == "openapi_parser", "api").otherwise("document"))


def by_parser(docs: DataFrame, parser: str) -> DataFrame:
    return docs.where(F.col("source_parser") == parser)


def records(spark: SparkSession, root: str, skip: str | None = "embedded_extraction_") -> DataFrame:
    """Extraction records of JSON lines; files whose names begin with ``skip`` are left out."""
    raw = spark.read.schema(RECORD).option("columnNameOfCorruptRecord", "_broken").json(root)
    if skip:
        raw = raw.where(~F.element_at(F.split(F.input_file_name(), "/"), -1).startswith(skip))
    return raw.where("_broken IS NULL").drop("_broken")


def record_entities(found: DataFrame) -> DataFrame:
    """Entities of all lists of a record; a type, else a label, else ``entity``; a name, else a text, else an id."""
    none = F.array().cast("array<map<string,string>>")
    e = found.select("source_id", "source_parser", F.posexplode(F.concat(*[F.coalesce(c, none) for c in ("entities", "spacy_entities", "llm_entities")])).alias("pos", "e"))
    at = lambda *keys: first_non_blank(*[F.try_element_at("e", F.lit(k)) for k in keys])
    return e.select("source_id", "source_parser", "pos", F.coalesce(at("type", "label"), F.lit("entity")).alias("type"), F.coalesce(at("name", "text", "id"), F.lit("unknown")).alias("name"), F.col("e").alias("properties"))


def record_edges(found: DataFrame) -> DataFrame:
    """Relationships and triples of records in one form."""
    none = F.array().cast("array<map<string,string>>")
    e = found.select("source_id", F.posexplode(F.concat(*[F.coalesce(c, none) for c in ("relationships", "triples")])).alias("pos", "e"))
    at = lambda *keys: first_non_blank(*[F.try_element_at("e", F.lit(k)) for k in keys])
    c = F.try_element_at("e", F.lit("confidence")).try_cast("double")
    return e.select("source_id", "pos", at("source", "subject", "subject_name", "source_entity_id").alias("source"), at("target", "object_name", "object", "target_entity_id").alias("target"), at("relationship", "relationship_type", "type", "predicate").alias("relation"), F.when(c.between(0, 1), c).otherwise(1.0).alias("confidence"))


def record_chunks(found: DataFrame) -> DataFrame:
    c = found.select("source_id", F.posexplode(F.coalesce("document_chunks", "chunks")).alias("pos", "c"))
    return c.where(strip(F.col("c.text")) != "").select("source_id", "pos", "c.text", "c.label")


def configured(spark: SparkSession, raw: str, required: tuple[str, ...]) -> DataFrame:
    """A list of sources or repositories from JSON: enabled ones, all of which must have the required fields."""
    out = spark.createDataFrame([(raw,)], "raw string").select(F.explode(F.from_json("raw", "array<map<string,string>>")).alias("c"))
    for k in required:
        out = out.withColumn("c", F.when(first_non_blank(F.try_element_at("c", F.lit(k))).isNull(), F.raise_error(F.lit(f"missing field {k}")).cast("map<string,string>")).otherwise(F.col("c")))
    return out.where(F.coalesce(F.lower(F.try_element_at("c", F.lit("enabled"))), F.lit("true")) != "false").select(*[F.try_element_at("c", F.lit(k)).alias(k) for k in required])


def new_only(candidates: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """What the log of earlier runs doesn't hold."""
    return candidates.join(log.select(key), key, "left_anti")
