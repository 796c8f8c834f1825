"""Queries over API specifications that are made from suppliers' rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from graphloom.operators import openapi as oa
from graphloom.plans.base import duck, quoted, rows

_SPEC = {
    "openapi": "3.0.1",
    "info": {"title": " Supplier #K# ", "version": "#V#", "description": "About supplier #K#. " * 12, "x-group": "g#M#", "x-audience": "all"},
    "servers": [{"url": "https://s#K#.example.com"}, {"url": "/"}],
    "paths": {
        "/suppliers/{id}": {
            "summary": "one",
            "get": {
                "operationId": "get#K#", "tags": ["t#M#", "read"], "security": [{"key": []}, {"gone": []}],
                "parameters": [{"name": "id", "in": "path", "required": True, "schema": {"type": "string"}}, {"name": "page", "in": "query", "schema": {"type": "integer"}}, {"name": "odd#M#", "in": "header"}],
                "responses": {"200": {"description": "ok", "content": {"application/json": {"schema": {"$ref": "#/components/schemas/Supplier#M#"}}}}, "404": {"$ref": "#/components/responses/E_404_missing"}},
            },
            "put": {"requestBody": {"$ref": "#/components/requestBodies/Body"}, "security": [{"oauth": ["w"], "key": []}], "responses": {"204": {"description": "none"}}},
            "x-note": {"a": 1},
        },
        "/list#M#": {"post": {"summary": "List", "requestBody": {"content": {"application/json": {"schema": {"$ref": "#/components/schemas/Filter"}}}}, "responses": {"200": {"$ref": "#/components/responses/Page"}}}},
    },
    "components": {
        "schemas": {
            "Supplier#M#": {"type": "object", "description": "d#K#", "required": ["name"], "properties": {"name": {"type": "string"}, "nation": {"$ref": "#/components/schemas/Nation"}, "state": {"type": "string", "enum": ["A", "B#M#"]}, "parent": {"$ref": "#/components/schemas/Supplier#M#"}}},
            "Nation": {"type": "string", "enum": ["N#M#", "X"]},
            "Filter": {"allOf": [{"$ref": "#/components/schemas/Nation"}, {"type": "object"}], "oneOf": [{"$ref": "#/components/schemas/Gone"}]},
            "Error": {"type": "object", "properties": {"detail": {"$ref": "other.yml#/Detail"}}},
        },
        "parameters": {"id": {"in": "path", "required": True, "schema": {"type": "string"}}, "page": {"in": "query", "deprecated": True, "schema": {"$ref": "#/components/schemas/Nation"}}, "odd0": {"in": "query"}},
        "requestBodies": {"Body": {"required": True, "content": {"application/json": {"schema": {"$ref": "#/components/schemas/Supplier#M#"}}, "text/plain": {"schema": {"type": "string"}}}}},
        "responses": {
            "E_404_missing": {"description": "no #K#", "content": {"application/json": {"schema": {"$ref": "#/components/schemas/Error"}}}},
            "Page": {"description": "page", "content": {"application/json": {"schema": {"type": "array", "items": {"$ref": "#/components/schemas/Nation"}}}}},
        },
        "securitySchemes": {"key": {"type": "apiKey", "in": "header", "name": "X-K#M#"}, "bearer": {"type": "HTTP", "scheme": "bearer"}, "oauth": {"type": "oauth2", "flows": {}}},
    },
}
_TEXT = quoted(json.dumps(_SPEC, separators=(",", ":")))
SPECS = f"""SELECT s_suppkey AS spec, replace(replace(replace({_TEXT}, '#K#', CAST(s_suppkey AS STRING)), '#M#', CAST(s_suppkey % 3 AS STRING)), '#V#', CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE '1.' || CAST(s_suppkey AS STRING) END) AS text FROM @supplier"""
D = duck(SPECS)
CHUNKS = "SELECT 's' || CAST(doc_id AS STRING) AS slug, replace(text, chr(10), chr(10) || chr(10)) AS text FROM @documents"


def specs(spark, d):
    return rows(spark, d, SPECS)


def joined(c: str):
    return F.array_join(c, "|").alias(c)


def d_children(path: str, source: str = D, name: str = "name") -> str:
    return f"SELECT spec, {name}, json_extract(text, '{path}.\"' || {name} || '\"') AS body FROM (SELECT spec, text, unnest(json_keys(text, '{path}')) AS {name} FROM ({source}))"


def d_kind(kind: str) -> str:
    return d_children(f"$.components.{kind}")


D_ITEMS = d_children("$.paths", name="path")
D_CALLS = f"""SELECT spec, upper(m) AS method, path, json_extract(body, '$.' || m) AS op FROM (SELECT spec, path, body, unnest(json_keys(body)) AS m FROM ({D_ITEMS})) WHERE lower(m) IN ({', '.join(map(quoted, oa.METHODS))})"""
D_PARAMETERS = f"SELECT spec, method, path, CAST(k - 1 AS INTEGER) AS pos, p ->> '$.name' AS name, p ->> '$.in' AS location, coalesce(CAST(p ->> '$.required' AS BOOLEAN), false) AS required, p ->> '$.schema.type' AS type FROM (SELECT spec, method, path, k, ps[k] AS p FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS k FROM (SELECT *, CAST(op -> '$.parameters' AS JSON[]) AS ps FROM ({D_CALLS}))))"
_STR = lambda p: f"body ->> '{p}'"
D_REFS = "regexp_extract_all(CAST({x} AS VARCHAR), '\"\\$ref\"\\s*:\\s*\"([^\"]*)\"', 1)"
D_SCHEMAS = f"SELECT spec, name, body, nullif({_STR('$.type')}, '') AS type, nullif({_STR('$.description')}, '') AS description, coalesce(array_to_string(CAST(body -> '$.enum' AS VARCHAR[]), '|'), '') AS enum, coalesce(array_to_string(CAST(body -> '$.required' AS VARCHAR[]), '|'), '') AS required FROM ({d_kind('schemas')})"
D_PROPERTIES = f"""SELECT spec, schema, name, p ->> '$.type' AS type, p ->> '$."$ref"' AS ref, coalesce(list_contains(CAST(body -> '$.required' AS VARCHAR[]), name), false) AS required, CAST(coalesce(json_array_length(p, '$.enum'), 0) AS INTEGER) AS n_enum FROM (
  SELECT spec, schema, name, body, body -> ('$.properties.' || name) AS p FROM (SELECT spec, name AS schema, body, unnest(json_keys(body, '$.properties')) AS name FROM ({d_kind('schemas')}) WHERE json_exists(body, '$.properties')))"""
D_COMPOSED = f"SELECT spec, name, unnest(list_concat({D_REFS.format(x="body -> '$.allOf'")}, coalesce({D_REFS.format(x="body -> '$.oneOf'")}, []), coalesce({D_REFS.format(x="body -> '$.anyOf'")}, []))) AS ref FROM ({d_kind('schemas')}) WHERE json_exists(body, '$.allOf')"
D_EVERY = " UNION ALL ".join(f"SELECT spec, '#/components/{k}/' || name AS ref, body FROM ({d_kind(k)})" for k in ("parameters", "requestBodies", "responses", "securitySchemes"))


def d_reached(texts: str) -> str:
    return f"""WITH RECURSIVE comp AS ({D_EVERY}), reach AS (SELECT spec, method, path, unnest({D_REFS.format(x='body')}) AS ref FROM ({texts}) UNION SELECT r.spec, r.method, r.path, unnest({D_REFS.format(x='comp.body')}) FROM reach r JOIN comp ON comp.spec = r.spec AND comp.ref = r.ref)
SELECT DISTINCT spec, method, path, replace(ref, '{oa.SCHEMA_REF}', '') AS target FROM reach WHERE starts_with(ref, '{oa.SCHEMA_REF}')"""


D_RETURNS = d_reached(f"SELECT spec, method, path, op -> '$.responses' AS body FROM ({D_CALLS})")
D_ACCEPTS = d_reached(f"SELECT spec, method, path, op -> '$.requestBody' AS body FROM ({D_CALLS}) WHERE json_exists(op, '$.requestBody')")
D_SCHEMA_EDGES = f"""SELECT DISTINCT spec, source, target FROM (SELECT spec, name AS source, replace(ref, '{oa.SCHEMA_REF}', '') AS target FROM ({D_COMPOSED}) UNION ALL SELECT spec, schema, replace(ref, '{oa.SCHEMA_REF}', '') FROM ({D_PROPERTIES}) WHERE ref IS NOT NULL) e
WHERE EXISTS (SELECT 1 FROM ({d_kind('schemas')}) s WHERE s.spec = e.spec AND s.name = e.target)"""
D_PARAMETER_EDGES = f"SELECT spec, method, path, name, location FROM ({D_PARAMETERS}) p WHERE EXISTS (SELECT 1 FROM ({d_kind('parameters')}) c WHERE c.spec = p.spec AND c.name = p.name AND c.body ->> '$.in' = p.location)"
D_SECURITY_EDGES = f"""SELECT spec, method, path, scheme FROM (SELECT spec, method, path, unnest(json_keys(r)) AS scheme FROM (SELECT spec, method, path, unnest(CAST(op -> '$.security' AS JSON[])) AS r FROM ({D_CALLS}))) e WHERE EXISTS (SELECT 1 FROM ({d_kind('securitySchemes')}) s WHERE s.spec = e.spec AND s.name = e.scheme)"""

QUERIES = {
    "oa_info": lambda spark, d: oa.info(specs(spark, d)).withColumn("extensions", joined("extensions")),
    "oa_info_faulty": lambda spark, d: oa.faulty(specs(spark, d)),
    "oa_endpoints": lambda spark, d: oa.endpoints(specs(spark, d)).select("spec", "method", "path", "op.operationId", "op.summary", F.coalesce(F.array_join("op.tags", "|"), F.lit("")).alias("tags")),
    "oa_endpoint_parameters": lambda spark, d: oa.endpoint_parameters(oa.endpoints(specs(spark, d))),
    "oa_parameters": lambda spark, d: oa.parameters(specs(spark, d)),
    "oa_schemas": lambda spark, d: oa.schemas(specs(spark, d)).select("spec", "name", "type", "description", joined("enum"), joined("required")),
    "oa_properties": lambda spark, d: oa.properties(oa.schemas(specs(spark, d))),
    "oa_enums": lambda spark, d: oa.schemas(specs(spark, d)).select("spec", "name", F.posexplode("enum").alias("pos", "value")),
    "oa_composition_refs": lambda spark, d: oa.schemas(specs(spark, d)).select("spec", "name", F.explode("refs").alias("ref")),
    "oa_security": lambda spark, d: oa.security_schemes(specs(spark, d)),
    "oa_request_bodies": lambda spark, d: oa.request_bodies(specs(spark, d)),
    "oa_responses": lambda spark, d: oa.responses(specs(spark, d)),
    "oa_refs": lambda spark, d: specs(spark, d).select("spec", F.explode(F.array_distinct(oa.refs(F.col("text")))).alias("ref")),
    "oa_edges_returns": lambda spark, d: oa.returns(specs(spark, d)),
    "oa_edges_accepts": lambda spark, d: oa.accepts(specs(spark, d)),
    "oa_edges_schema": lambda spark, d: oa.schema_references(specs(spark, d)),
    "oa_edges_parameter": lambda spark, d: oa.parameter_edges(specs(spark, d)),
    "oa_edges_security": lambda spark, d: oa.security_edges(specs(spark, d)),
    "oa_edges_all": lambda spark, d: oa.edges(specs(spark, d)).groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("target").alias("n_targets")),
    "oa_deref": lambda spark, d: specs(spark, d).select("spec", oa.dereferenced("text").alias("text")),
    "oa_chunk_id": lambda spark, d: oa.chunks(rows(spark, d, CHUNKS)).select("slug", "chunk_order", "chunk_id"),
    "oa_distinct_titles": lambda spark, d: oa.info(specs(spark, d)).agg(F.countDistinct("title").alias("apis_discovered"), F.count("*").alias("n")),
}
_DESCRIPTION = "trim(text ->> '$.info.description')"
D_INFO = f"""SELECT spec, trim(text ->> '$.info.title') AS title, trim(text ->> '$.info.version') AS version, CASE WHEN length({_DESCRIPTION}) > 200 THEN rtrim({_DESCRIPTION}[1:197]) || '...' ELSE {_DESCRIPTION} END AS summary, text ->> '$.openapi' AS openapi_version,
  CAST(json_array_length(text, '$.servers') AS INTEGER) AS n_servers, array_to_string(list_sort(list_filter(json_keys(text, '$.info'), lambda k: starts_with(k, 'x-'))), '|') AS extensions FROM ({D}) WHERE trim(text ->> '$.info.version') <> ''"""
_MEDIA = "body -> '$.content.\"application/json\".schema'"
ORACLES = {
    "oa_info": D_INFO,
    "oa_info_faulty": f"SELECT spec, 'version' AS lacks FROM ({D}) WHERE trim(text ->> '$.info.version') = ''",
    "oa_endpoints": f"""SELECT spec, method, path, op ->> '$.operationId' AS "operationId", op ->> '$.summary' AS summary, coalesce(array_to_string(CAST(op -> '$.tags' AS VARCHAR[]), '|'), '') AS tags FROM ({D_CALLS})""",
    "oa_endpoint_parameters": D_PARAMETERS,
    "oa_parameters": f"""SELECT spec, name, {_STR('$.in')} AS location, coalesce(CAST({_STR('$.required')} AS BOOLEAN), false) AS required, coalesce(CAST({_STR('$.deprecated')} AS BOOLEAN), false) AS deprecated, {_STR('$.schema.type')} AS type, {_STR('$.schema."$ref"')} AS ref FROM ({d_kind('parameters')})""",
    "oa_schemas": f"SELECT spec, name, type, description, enum, required FROM ({D_SCHEMAS})",
    "oa_properties": D_PROPERTIES,
    "oa_enums": f"SELECT spec, name, CAST(k - 1 AS INTEGER) AS pos, es[k] AS value FROM (SELECT spec, name, es, unnest(range(1, len(es) + 1)) AS k FROM (SELECT spec, name, CAST(body -> '$.enum' AS VARCHAR[]) AS es FROM ({d_kind('schemas')}) WHERE json_exists(body, '$.enum')))",
    "oa_composition_refs": D_COMPOSED,
    "oa_security": f"SELECT spec, name, lower({_STR('$.type')}) AS type, {_STR('$.scheme')} AS scheme, {_STR('$.in')} AS location, {_STR('$.name')} AS parameter FROM ({d_kind('securitySchemes')})",
    "oa_request_bodies": f"""SELECT spec, name, CAST({_STR('$.required')} AS BOOLEAN) AS required, array_to_string(json_keys(body, '$.content'), ',') AS media, {_MEDIA} ->> '$."$ref"' AS ref, {_MEDIA} ->> '$.type' AS type FROM ({d_kind('requestBodies')})""",
    "oa_responses": f"""SELECT spec, name, nullif(regexp_extract(name, '(?:^|_)(\\d{{3}})(?:_|$)', 1), '') AS status, {_STR('$.description')} AS description, {_MEDIA} ->> '$."$ref"' AS ref FROM ({d_kind('responses')})""",
    "oa_refs": f"SELECT DISTINCT spec, unnest({D_REFS.format(x='text')}) AS ref FROM ({D})",
    "oa_edges_returns": D_RETURNS,
    "oa_edges_accepts": D_ACCEPTS,
    "oa_edges_schema": D_SCHEMA_EDGES,
    "oa_edges_parameter": D_PARAMETER_EDGES,
    "oa_edges_security": D_SECURITY_EDGES,
    "oa_edges_all": f"SELECT type, count(*) AS n, count(DISTINCT target) AS n_targets FROM (SELECT 'RETURNS' AS type, target FROM ({D_RETURNS}) UNION ALL SELECT 'ACCEPTS', target FROM ({D_ACCEPTS}) UNION ALL SELECT 'REFERENCES_SCHEMA', target FROM ({D_SCHEMA_EDGES}) UNION ALL SELECT 'HAS_PARAMETER', name FROM ({D_PARAMETER_EDGES}) UNION ALL SELECT 'REQUIRES_SECURITY', scheme FROM ({D_SECURITY_EDGES})) GROUP BY type",
    "oa_chunk_id": f"SELECT slug, CAST(k - 1 AS INTEGER) AS chunk_order, slug || '_' || substr(sha1(cs[k]), 1, 8) AS chunk_id FROM (SELECT slug, cs, unnest(range(1, len(cs) + 1)) AS k FROM (SELECT slug, list_filter(regexp_split_to_array(text, '\\n[ \\t]*\\n'), lambda x: trim(x) <> '') AS cs FROM ({duck(CHUNKS)})))",
    "oa_distinct_titles": f"SELECT count(DISTINCT title) AS apis_discovered, count(*) AS n FROM ({D_INFO})",
}
