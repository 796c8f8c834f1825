"""API specifications as rows. A specification is JSON text (``spec``, ``text``); YAML becomes JSON first."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METHODS = ("get", "post", "put", "patch", "delete", "options", "head")
SCHEMA_REF = "#/components/schemas/"
#: References that are followed from one component to the next, and levels of a dereferenced tree.
FOLLOWED, DEPTH = 5, 200
_SHAPE = """struct<openapi:string,swagger:string,info:map<string,string>,servers:array<string>,externalDocs:map<string,string>,paths:map<string,string>,
  components:struct<schemas:map<string,string>,parameters:map<string,string>,requestBodies:map<string,string>,responses:map<string,string>,securitySchemes:map<string,string>>>"""
_SCHEMA = "struct<type:string,`$ref`:string,format:string,enum:array<string>>"
_PARAMETER = f"struct<name:string,`in`:string,required:boolean,deprecated:boolean,description:string,schema:{_SCHEMA}>"
_OPERATION = f"struct<operationId:string,summary:string,tags:array<string>,parameters:array<{_PARAMETER}>,requestBody:string,responses:map<string,string>,security:array<map<string,string>>>"
_REF = r'"\$ref"\s*:\s*"([^"]*)"'


@F.pandas_udf(T.StringType())
def yaml_to_json(texts: pd.Series) -> pd.Series:
    """JSON of a YAML mapping, with its keys in their order; null if it isn't one."""
    import yaml

    def one(text):
        try:
            made = yaml.safe_load(text) if text else None
        except yaml.YAMLError:
            return None
        return json.dumps(made, default=str, ensure_ascii=False) if isinstance(made, dict) else None

    return texts.map(one)


def parsed(specs: DataFrame) -> DataFrame:
    return specs.withColumn("s", F.from_json("text", _SHAPE))


def blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def info(specs: DataFrame, summary: int = 200) -> DataFrame:
    """Title and version, both needed: rows without go to :func:`faulty`."""
    i = lambda k: blank(F.try_element_at("s.info", F.lit(k)))
    out = parsed(specs).withColumn("title", i("title")).withColumn("version", i("version")).withColumn("description", i("description")).where("title IS NOT NULL AND version IS NOT NULL")
    short = F.when(F.length("description") > summary, F.concat(F.rtrim(F.substr("description", F.lit(1), F.lit(summary - 3))), F.lit("..."))).otherwise(F.col("description"))
    extra = F.array_sort(F.filter(F.map_keys("s.info"), lambda k: k.startswith("x-")))
    return out.select("spec", "title", "version", short.alias("summary"), F.coalesce("s.openapi", "s.swagger").alias("openapi_version"), F.coalesce(F.size("s.servers"), F.lit(0)).alias("n_servers"), extra.alias("extensions"))


def faulty(specs: DataFrame) -> DataFrame:
    """Specifications without a title or a version, and what they lack."""
    i = lambda k: blank(F.try_element_at("s.info", F.lit(k)))
    lacks = F.when(F.col("s.info").isNull(), "info").when(i("title").isNull(), "title").when(i("version").isNull(), "version")
    return parsed(specs).select("spec", lacks.alias("lacks")).where("lacks IS NOT NULL")


def endpoints(specs: DataFrame) -> DataFrame:
    """One row per path and method, with ``op`` as parsed operation."""
    paths = parsed(specs).select("spec", F.explode("s.paths").alias("path", "item"))
    calls = paths.select("spec", "path", F.explode(F.from_json("item", "map<string,string>")).alias("method", "operation"))
    calls = calls.where(F.lower("method").isin(*METHODS) & F.col("operation").startswith("{"))
    return calls.select("spec", F.upper("method").alias("method"), "path", F.from_json("operation", _OPERATION).alias("op"))


def endpoint_parameters(calls: DataFrame) -> DataFrame:
    p = calls.select("spec", "method", "path", F.posexplode("op.parameters").alias("pos", "p"))
    return p.select("spec", "method", "path", "pos", F.coalesce("p.name", F.lit("")).alias("name"), F.coalesce("p.in", F.lit("")).alias("location"), F.coalesce("p.required", F.lit(False)).alias("required"), F.col("p.schema.type").alias("type"))


def components(specs: DataFrame, kind: str) -> DataFrame:
    """``spec``, ``name``, ``body`` (JSON) of the components of a kind that are mappings."""
    return parsed(specs).select("spec", F.explode(F.col(f"s.components.{kind}")).alias("name", "body")).where(F.col("body").startswith("{"))


def parameters(specs: DataFrame) -> DataFrame:
    p = components(specs, "parameters").withColumn("p", F.from_json("body", _PARAMETER))
    return p.select("spec", "name", F.coalesce("p.in", F.lit("")).alias("location"), F.coalesce("p.required", F.lit(False)).alias("required"), F.coalesce("p.deprecated", F.lit(False)).alias("deprecated"), F.col("p.schema.type").alias("type"), F.col("p.schema.$ref").alias("ref"))


def schemas(specs: DataFrame) -> DataFrame:
    shape = "struct<type:string,description:string,enum:array<string>,required:array<string>,properties:map<string,string>,allOf:array<map<string,string>>,oneOf:array<map<string,string>>,anyOf:array<map<string,string>>>"
    out = components(specs, "schemas").withColumn("s", F.from_json("body", shape))
    none = F.array().cast("array<string>")
    refs = F.flatten(F.array(*[F.coalesce(F.filter(F.transform(f"s.{k}", lambda m: F.try_element_at(m, F.lit("$ref"))), lambda r: r.isNotNull()), none) for k in ("allOf", "oneOf", "anyOf")]))
    return out.select("spec", "name", "body", F.nullif("s.type", F.lit("")).alias("type"), F.nullif("s.description", F.lit("")).alias("description"), F.coalesce("s.enum", none).alias("enum"), F.coalesce("s.required", none).alias("required"), F.col("s.properties").alias("properties"), refs.alias("refs"))


def properties(found: DataFrame) -> DataFrame:
    p = found.select("spec", F.col("name").alias("schema"), "required", F.explode("properties").alias("name", "body")).where(F.col("body").startswith("{"))
    p = p.withColumn("p", F.from_json("body", "struct<type:string,`$ref`:string,format:string,enum:array<string>>"))
    return p.select("spec", "schema", "name", F.col("p.type").alias("type"), F.col("p.$ref").alias("ref"), F.array_contains("required", F.col("name")).alias("required"), F.coalesce(F.size("p.enum"), F.lit(0)).alias("n_enum"))


def security_schemes(specs: DataFrame) -> DataFrame:
    s = components(specs, "securitySchemes").withColumn("s", F.from_json("body", "struct<type:string,scheme:string,bearerFormat:string,`in`:string,name:string>"))
    return s.select("spec", "name", F.lower(F.coalesce("s.type", F.lit(""))).alias("type"), F.col("s.scheme").alias("scheme"), F.col("s.in").alias("location"), F.col("s.name").alias("parameter"))


def _media(content: Column) -> Column:
    """First media type's schema: its reference or its type."""
    return F.from_json(F.get(F.map_values(F.from_json(content, "map<string,string>")), F.lit(0)), "struct<schema:struct<`$ref`:string,type:string>>")


def request_bodies(specs: DataFrame) -> DataFrame:
    b = components(specs, "requestBodies").withColumn("b", F.from_json("body", "struct<description:string,required:boolean,content:string>")).withColumn("m", _media(F.col("b.content")))
    return b.select("spec", "name", F.coalesce("b.required", F.lit(False)).alias("required"), F.array_join(F.map_keys(F.from_json("b.content", "map<string,string>")), ",").alias("media"), F.col("m.schema.$ref").alias("ref"), F.col("m.schema.type").alias("type"))


def responses(specs: DataFrame) -> DataFrame:
    """``status``: the first part of the name, cut at ``_``, that is three digits."""
    status = F.get(F.filter(F.split("name", "_"), lambda x: x.rlike("^[0-9]{3}$")), F.lit(0))
    b = components(specs, "responses").withColumn("b", F.from_json("body", "struct<description:string,content:string>")).withColumn("m", _media(F.col("b.content")))
    return b.select("spec", "name", status.alias("status"), F.col("b.description").alias("description"), F.col("m.schema.$ref").alias("ref"))


def refs(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(_REF), F.lit(1))


def schema_name(ref: Column) -> Column:
    return F.when(ref.startswith(SCHEMA_REF), F.substr(ref, F.lit(len(SCHEMA_REF) + 1)))


def reached_schemas(specs: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """Schemas that JSON texts (``body``) refer to, directly or through other components, a bounded number of steps on."""
    kinds = ("parameters", "requestBodies", "responses", "securitySchemes")

    def named(kind: str) -> Column:
        entries = F.coalesce(F.map_entries(f"s.components.{kind}"), F.array().cast("array<struct<key:string,value:string>>"))
        return F.transform(entries, lambda e: F.struct(F.concat(F.lit(f"#/components/{kind}/"), e["key"]).alias("ref"), e["value"].alias("next")))

    every = parsed(specs).select("spec", F.inline(F.flatten(F.array(*map(named, kinds))))).where(F.col("next").startswith("{"))
    step = texts.select(*keys, F.explode(refs(F.col("body"))).alias("ref")).distinct()
    found = step
    for _ in range(FOLLOWED):
        on = step.where(~F.col("ref").startswith(SCHEMA_REF)).join(every, ["spec", "ref"]).select(*keys, F.explode(refs(F.col("next"))).alias("ref")).distinct()
        found, step = found.union(on), on
    return found.withColumn("target", schema_name(F.col("ref"))).where("target IS NOT NULL").select(*keys, "target").distinct()


def call_schemas(specs: DataFrame) -> DataFrame:
    """RETURNS and ACCEPTS edges of endpoints, in one pass over the references."""
    calls = endpoints(specs)
    bodies = calls.select("spec", "method", "path", F.lit("RETURNS").alias("type"), F.explode("op.responses").alias("status", "body")).drop("status")
    bodies = bodies.union(calls.select("spec", "method", "path", F.lit("ACCEPTS"), "op.requestBody")).where("body IS NOT NULL")
    return reached_schemas(specs, bodies, ["spec", "method", "path", "type"])


def returns(specs: DataFrame) -> DataFrame:
    return call_schemas(specs).where("type = 'RETURNS'").drop("type")


def accepts(specs: DataFrame) -> DataFrame:
    return call_schemas(specs).where("type = 'ACCEPTS'").drop("type")


def schema_references(specs: DataFrame) -> DataFrame:
    """Composition and property references to schemas that exist."""
    found = schemas(specs)
    used = found.select("spec", "name", F.explode("refs").alias("ref")).union(properties(found).select("spec", F.col("schema").alias("name"), "ref").where("ref IS NOT NULL"))
    named = used.withColumn("target", schema_name(F.col("ref"))).where("target IS NOT NULL")
    return named.join(found.select("spec", F.col("name").alias("target")), ["spec", "target"], "left_semi").select("spec", F.col("name").alias("source"), "target").distinct()


def parameter_edges(specs: DataFrame) -> DataFrame:
    """Endpoint parameters and the components of the same name and place."""
    return endpoint_parameters(endpoints(specs)).join(parameters(specs).select("spec", "name", "location"), ["spec", "name", "location"], "left_semi").select("spec", "method", "path", "name", "location")


def security_edges(specs: DataFrame) -> DataFrame:
    wanted = endpoints(specs).select("spec", "method", "path", F.explode("op.security").alias("r")).select("spec", "method", "path", F.explode(F.map_keys("r")).alias("scheme"))
    return wanted.join(security_schemes(specs).select("spec", F.col("name").alias("scheme")), ["spec", "scheme"], "left_semi").select("spec", "method", "path", "scheme")


def edges(specs: DataFrame) -> DataFrame:
    """All edges of the specifications in one table."""
    call = F.concat_ws(" ", "method", "path").alias("source")
    return (
        call_schemas(specs).select("spec", call, "target", "type").union(schema_references(specs).select("spec", "source", "target", F.lit("REFERENCES_SCHEMA"))).union(parameter_edges(specs).select("spec", call, F.col("name"), F.lit("HAS_PARAMETER")))
        .union(security_edges(specs).select("spec", call, F.col("scheme"), F.lit("REQUIRES_SECURITY")))
    )


def inline(spec: dict, depth: int = DEPTH) -> dict:
    """The specification with each internal reference replaced by what it points to; a reference inside itself, an
    external one and one to nothing stay, marked as such."""

    def target(ref: str):
        at = spec
        for part in ref[2:].split("/"):
            if not isinstance(at, dict) or part not in at:
                return None
            at = at[part]
        return at

    def walk(node, inside: tuple[str, ...]):
        if len(inside) > depth:
            return node
        if isinstance(node, list):
            return [walk(x, inside) for x in node]
        if not isinstance(node, dict):
            return node
        ref = node.get("$ref")
        if not isinstance(ref, str):
            return {k: walk(v, inside) for k, v in node.items()}
        if ref in inside:
            return {"$ref": ref, "ref_cycle_detected": True}
        if not ref.startswith("#"):
            return {"$ref": ref, "ref_type": "external"}
        found = target(ref) if ref.startswith("#/") else None
        return {"$ref": ref, "ref_resolved": False} if found is None else walk(found, (*inside, ref))

    return walk(spec, ())


@F.pandas_udf(T.StringType())
def dereferenced(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: json.dumps(inline(json.loads(t)), separators=(",", ":"), sort_keys=True) if t else None)


def chunk_id(slug: Column, text: Column) -> Column:
    return F.concat_ws("_", slug, F.substr(F.sha1(text), F.lit(1), F.lit(8)))


def chunks(docs: DataFrame) -> DataFrame:
    """Blank lines part a text; chunks are numbered and named by their content."""
    parts = F.filter(F.split("text", r"\n[ \t]*\n"), lambda x: F.trim(x) != "")
    return docs.select("slug", F.posexplode(parts).alias("chunk_order", "chunk")).withColumn("chunk_id", chunk_id(F.col("slug"), F.col("chunk")))
