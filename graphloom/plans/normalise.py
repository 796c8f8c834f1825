"""Queries of name rules, canonical entities, deduplication, relationships and the graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import names, tables
from graphloom.operators import components, entities, relationships
from graphloom.plans.base import duck, duck_map, quoted, rows, table

#: Names as parsers give them, made from the part table.
NAMES = """
SELECT p_partkey AS pos,
  CASE p_partkey % 10 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_') || 'Controller' WHEN 2 THEN upper(replace(p_name, ' ', '-'))
    WHEN 3 THEN 'POST /v1/' || replace(p_name, ' ', '-') || 's/{partId}' WHEN 4 THEN replace(p_name, ' ', '') || 'ServiceImpl' WHEN 5 THEN '/' || lower(p_type) || '/statuses'
    WHEN 6 THEN CASE WHEN p_size % 3 = 0 THEN 'PaymentService' WHEN p_size % 3 = 1 THEN 'Get Account' ELSE 'PaymentDTO' END
    WHEN 7 THEN 'get_capabilities_' || lower(p_type) WHEN 8 THEN 'XMLHttp' || p_type || 'URL x y' ELSE '  ' END AS name,
  CASE p_partkey % 4 WHEN 0 THEN 'Class' WHEN 1 THEN ' controller ' WHEN 2 THEN 'ENDPOINT' ELSE p_type END AS type,
  CASE p_partkey % 10 WHEN 1 THEN 'java_parser' WHEN 3 THEN 'openapi_parser' WHEN 4 THEN 'spring_parser' WHEN 5 THEN 'yaml_parser' ELSE 'markdown_parser' END AS source_parser,
  CAST(p_size AS DOUBLE) / 64 AS confidence, p_brand AS brand
FROM @part
"""


def d_lit(*values: str) -> str:
    return "(" + ", ".join(map(quoted, values)) + ")"


def d_pascal(c: str) -> str:
    spaced = f"regexp_replace(regexp_replace({c}, '([a-z\\d])([A-Z])', '\\1 \\2', 'g'), '([A-Z])([A-Z][a-z])', '\\1 \\2', 'g')"
    return f"array_to_string(list_transform(list_filter(regexp_split_to_array({spaced}, '[\\s_\\-./\\\\|]+'), lambda p: p <> ''), lambda p: upper(p[1]) || lower(p[2:])), '')"


def d_java(c: str) -> str:
    return "CASE " + " ".join(f"WHEN trim({c}) LIKE '%{s}' AND length(trim({c})) > {len(s)} THEN trim({c})[:-{len(s) + 1}]" for s in tables.JAVA_SUFFIXES) + f" ELSE trim({c}) END"


def d_singular(c: str) -> str:
    return f"CASE WHEN lower({c}) IN {d_lit(*tables.NOT_PLURAL)} THEN {c} WHEN lower({c}) LIKE '%ies' AND length({c}) > 4 THEN {c}[:-4] || 'y' WHEN lower({c}) LIKE '%ses' AND length({c}) > 4 THEN {c}[:-3] WHEN lower({c}) LIKE '%s' AND length({c}) > 3 AND lower({c}) NOT LIKE '%ss' THEN {c}[:-2] ELSE {c} END"


_D_PREFIX = "(?i)^(?:" + "|".join(tables.HTTP_METHODS) + ")\\s+"


def d_resource(c: str) -> str:
    last = f"list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace({c}, '{_D_PREFIX}', '')), '\\{{[^}}]+\\}}', '', 'g'), '/'), lambda s: trim(s)), lambda s: s <> '')[-1]"
    return f"coalesce({d_singular(last)}, {c})"


def d_source(c: str, parser: str) -> str:
    return f"CASE WHEN trim({c}) = '' THEN NULL WHEN {parser} IN {d_lit(*tables.JAVA_PARSERS)} THEN nullif({d_java(c)}, {c}) WHEN {parser} IN {d_lit(*tables.OPENAPI_PARSERS)} AND (contains({c}, '/') OR regexp_matches({c}, '{_D_PREFIX}')) THEN nullif({d_resource(c)}, {c}) END"


def d_abbreviations(c: str) -> str:
    """Runs of capitals, one by one, put back between the rest of the name."""


    pieces = f"regexp_extract_all({c}, '[A-Z]{{2,}}|[A-Z]|[^A-Z]+')"
    return f"array_to_string(list_transform({pieces}, lambda r: coalesce({duck_map(tables.ABBREVIATIONS, 'r')}, r)), '')"


D_SYNONYM = {a.lower(): k for k, listed in tables.SYNONYMS.items() for a in [k, *listed]}


def d_chain(source: str) -> str:
    """Steps of the rule chain as nested selects."""
    return f"""SELECT * REPLACE (nullif(trim(coalesce({duck_map(D_SYNONYM, 'lower(c)')}, c)), '') AS c) FROM (
      SELECT * REPLACE ({d_abbreviations('c')} AS c) FROM (SELECT * REPLACE (coalesce(nullif({d_pascal('c')}, ''), c) AS c) FROM (
      SELECT *, coalesce({d_source('name', 'source_parser')}, name) AS c FROM ({source}))))"""


def d_type(c: str) -> str:
    return f"coalesce({duck_map(tables.TYPES, f'lower(trim({c}))')}, {quoted(tables.TYPE_FALLBACK)})"


D_NAMES = duck(NAMES)
D_CANONICAL = f"SELECT *, c AS canonical_id, {d_type('type')} AS canonical_type FROM ({d_chain(D_NAMES)}) WHERE c IS NOT NULL"
D_MEAN = "floor(CAST(sum(CAST({c} AS DECIMAL(20, 8))) AS DOUBLE) / count({c}) * 10000 + 0.5) / 10000.0"
D_MERGED = f"""SELECT canonical_id, min_by(canonical_type, pos) AS type, list(name ORDER BY pos) AS all_names, count(*) AS n_sources, {D_MEAN.format(c='confidence')} AS confidence FROM ({D_CANONICAL}) GROUP BY canonical_id"""
D_ORDERED_DISTINCT = "list_transform(list_filter(list_zip({l}, range(1, len({l}) + 1)), lambda z: list_position({l}, z[1]) = z[2]), lambda z: z[1])"


def per_name(rule):
    return lambda spark, d: rows(spark, d, NAMES).select("pos", rule(F.col("name"), F.col("source_parser")).alias("result"))


def canonical(spark, d):
    return entities.canonicalise(rows(spark, d, NAMES))


def merged(spark, d):
    return entities.merge(canonical(spark, d))


def as_entities(spark, d):
    """Merged entities with the columns that deduplication takes; ``pos`` orders them by id."""
    out = merged(spark, d).withColumnRenamed("canonical_id", "id")
    return out.withColumn("pos", F.xxhash64("id"))


ADAPT = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE ' repo' || CAST(o_orderkey % 7 AS STRING) || ' ' END AS repository, CASE WHEN o_orderkey % 4 = 0 THEN 'r' || o_orderstatus END AS repo,
  o_orderpriority AS repo_name, CASE WHEN o_orderkey % 5 = 0 THEN 'high' WHEN o_orderkey % 5 = 1 THEN '1.5' WHEN o_orderkey % 5 = 2 THEN '0.25' END AS confidence, CASE WHEN o_orderkey % 2 = 0 THEN '0.75' END AS score FROM @orders"""

RAW = """
SELECT l_orderkey * 8 + l_linenumber AS pos, 'part ' || CAST(l_partkey % 300 AS STRING) AS source, 'Supplier-' || CAST(l_suppkey AS STRING) AS target,
  CASE l_linenumber WHEN 1 THEN 'calls' WHEN 2 THEN 'dependsOn' WHEN 3 THEN 'documented by' WHEN 4 THEN 'extends' WHEN 5 THEN '-returns-' WHEN 6 THEN 'unheard.of' ELSE 'Depends On' END AS relation,
  l_discount AS confidence FROM @lineitem
"""
NODES = """
SELECT 'Part' || CAST(p_partkey AS STRING) AS id, 'domain_entity' AS type, array('PART ' || CAST(p_partkey AS STRING), 'part ' || CAST(p_partkey + 1 AS STRING)) AS aliases, p_partkey AS pos FROM @part WHERE p_partkey % 3 <> 2
UNION ALL SELECT 'Supplier' || CAST(s_suppkey AS STRING), 'concept', array('supplier-' || CAST(s_suppkey AS STRING)), 1000000000 + s_suppkey FROM @supplier WHERE s_suppkey % 5 <> 0
"""
D_NODES = duck(NODES).replace("array(", "list_value(")
D_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(h, 17, 1)) AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"
_NS = "6ba7b8119dad11d180b400c04fd430c8"


def d_uuid(c: str) -> str:
    return f"list_transform([sha1(unhex('{_NS}') || encode({c}))], lambda h: {D_UUID})[1]"


def d_relation_key(c: str) -> str:
    return f"trim(upper(regexp_replace(regexp_replace(trim({c}), '([a-z\\d])([A-Z])', '\\1_\\2', 'g'), '[\\s\\-./]+', '_', 'g')), '_')"


def d_relation(c: str) -> str:
    return f"coalesce({duck_map(tables.RELATIONS, d_relation_key(c))}, {quoted(tables.RELATION_FALLBACK)})"


D_INDEX = f"SELECT lower(n) AS lower, max_by(id, pos) AS id FROM (SELECT id, pos, unnest(list_prepend(id, aliases)) AS n FROM ({D_NODES})) GROUP BY 1"
D_EDGES = f"""SELECT *, {d_uuid("'graph:relation:' || source_id || ':' || target_id || ':' || type")} AS id FROM (
  SELECT *, {d_uuid("'graph:entity:' || source")} AS source_id, {d_uuid("'graph:entity:' || target")} AS target_id FROM (
    SELECT r.pos, coalesce(s.id, r.source) AS source, coalesce(t.id, r.target) AS target, r.confidence, relation AS original_type, {d_relation('relation')} AS type
    FROM ({duck(RAW)}) r LEFT JOIN ({D_INDEX}) s ON lower(r.source) = s.lower LEFT JOIN ({D_INDEX}) t ON lower(r.target) = t.lower))"""
D_MERGED_EDGES = f"SELECT id, source, target, type, arg_max(original_type, struct_pack(a := confidence, b := -pos)) AS original_type, max(confidence) AS confidence, list_sort(list_distinct(list(original_type))) AS original_types, count(*) AS n_provenance FROM ({D_EDGES}) GROUP BY ALL"
D_MERGED_EDGES = D_MERGED_EDGES.replace("GROUP BY ALL", "GROUP BY id, source, target, type")


def edges(spark, d):
    return relationships.normalise_relationships(rows(spark, d, RAW), rows(spark, d, NODES))


def existing(spark, d):
    return relationships.existing_ends(relationships.merge_edges(edges(spark, d)), rows(spark, d, NODES))


def joined(c: str):
    return F.array_join(c, "|")


SHAPES = """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'spec.yml' END AS spec_source, CASE WHEN o_orderkey % 3 = 0 THEN 'CALLS' END AS relationship_type,
  CASE WHEN o_orderkey % 2 = 0 THEN 'src/A.java' ELSE 'a.md' END AS file_path, CASE WHEN o_orderkey % 7 = 0 THEN 'uses' END AS predicate, CASE WHEN o_orderkey % 11 = 0 THEN ' given ' END AS source_parser FROM @orders"""
D_SHAPE = "coalesce(nullif(trim(source_parser), ''), CASE WHEN spec_source IS NOT NULL THEN 'openapi_parser' WHEN relationship_type IS NOT NULL AND file_path LIKE '%.java' THEN 'java_parser' WHEN predicate IS NOT NULL THEN 'glm_triple_extractor' ELSE 'unknown' END)"

OLD_NODES = "SELECT p_partkey AS id, p_name AS name, p_brand AS label, CAST(NULL AS STRING) AS note FROM @part WHERE p_partkey % 3 <> 0"
NEW_NODES = "SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) END AS name, p_type AS label, 'new' AS note FROM @part WHERE p_partkey % 4 <> 1"

#: For duplicates: part names, with a third of them changed in a way that the match key forgets.
TWINS = """SELECT CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN upper(replace(p_name, ' ', '-')) ELSE replace(p_name, ' ', '') END || '.' || CAST(p_partkey AS STRING) AS id, p_type AS type,
  array(CASE WHEN p_partkey % 5 = 0 THEN p_name || ' ' || p_brand || ' ' || CAST(p_size AS STRING) ELSE p_name || '_' || CAST(p_partkey AS STRING) || 'x' END,
    CASE p_partkey % 400 WHEN 7 THEN 'payment_dto' WHEN 8 THEN 'PaymentInitiationRequest' WHEN 9 THEN 'account dto' ELSE 'n' || CAST(p_partkey AS STRING) END) AS aliases,
  CAST(p_size % 4 AS BIGINT) AS n_sources, CAST(p_size AS DOUBLE) / 64 AS confidence FROM @part"""
#: Few names, many of them alike.
SIMILAR = "SELECT DISTINCT p_name AS id, array(p_name || 's', p_type) AS aliases FROM @part"
D_TWINS = duck(TWINS).replace("array(", "list_value(")
D_KEYS = f"SELECT DISTINCT id, lower(regexp_replace(n, '[\\s_\\-./\\\\|]+', '', 'g')) AS match FROM (SELECT id, unnest(list_prepend(id, aliases)) AS n FROM ({D_TWINS}))"
_KNOWN = {"".join(a.split()).lower(): k.lower() for k, listed in tables.DOMAINS.items() for a in [k, *listed]}
D_DOMAIN_KEYS = f"SELECT DISTINCT id, {duck_map(_KNOWN, 'match')} AS match FROM ({D_KEYS}) WHERE match IN {d_lit(*_KNOWN)}"


def d_links(keys: str, score: str, reason: str) -> str:
    return f"SELECT DISTINCT least_id AS left, id AS right, {score} AS score, '{reason}' AS reason FROM (SELECT *, min(id) OVER (PARTITION BY match) AS least_id FROM ({keys})) WHERE id <> least_id"


D_LINKS = f"{d_links(D_KEYS, '1.0::DOUBLE', 'exact_alias')} UNION ALL {d_links(D_DOMAIN_KEYS, '0.96::DOUBLE', 'domain_mapping')}"
_REACHED = """
WITH RECURSIVE link AS (SELECT "left" AS a, "right" AS b FROM (LINKS)), side AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(node, seen) AS (SELECT DISTINCT a, a FROM side UNION SELECT reach.node, side.b FROM reach JOIN side ON side.a = reach.seen)
SELECT node, min(seen) AS component FROM reach GROUP BY node"""
D_COMPONENTS = _REACHED.replace("LINKS", D_LINKS)
#: Vectors with one component more, and others that differ from them in it.
TURNED = "SELECT vec_id * 2 AS id, array_append(embedding, CAST(0 AS FLOAT)) AS embedding FROM @embeddings UNION ALL SELECT vec_id * 2 + 1, array_append(embedding, CAST(0.3 * (vec_id % 30) AS FLOAT)) FROM @embeddings"
D_NEAR = f'SELECT a.id AS "left", b.id AS "right" FROM ({duck(TURNED)}) a JOIN ({duck(TURNED)}) b ON a.id < b.id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.92'


def near_vectors(spark, d):
    """Components by the embedding rule: a spanning forest of the links has the same ones."""
    return components.connected_components(entities.cosine_links(rows(spark, d, TURNED)), "left", "right")


def links(spark, d):
    twins = rows(spark, d, TWINS)
    return entities.exact_alias_links(twins).union(entities.domain_links(twins))


def dedup(spark, d):
    return entities.deduplicate(rows(spark, d, TWINS), links(spark, d))


def vector_pairs(spark, d):
    """Cosine of each vector and the one that follows it in the table."""
    a = table(spark, d, "embeddings").select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.round(entities.cosine(F.col("embedding"), F.col("other")), 9).alias("cosine"))


def similar(spark, d):
    return entities.similar_names(rows(spark, d, SIMILAR)).select("left", "right", F.round("score", 4).alias("score"))


QUERIES = {
    "rule_pascal_case": per_name(lambda n, p: names.pascal_case(n)),
    "rule_abbreviation": per_name(lambda n, p: names.abbreviations(n)),
    "rule_source_pattern_java": per_name(lambda n, p: names.java_name(n)),
    "rule_source_pattern_openapi": per_name(lambda n, p: names.openapi_resource(n)),
    "rule_source_pattern": per_name(names.source_pattern),
    "rule_synonym": per_name(lambda n, p: names.synonym(names.pascal_case(n))),
    "rule_type_map": lambda spark, d: rows(spark, d, NAMES).select("pos", names.canonical_type(F.col("type")).alias("result")),
    "rule_chain_canonical_id": lambda spark, d: canonical(spark, d).select("pos", "canonical_id", "canonical_type"),
    "entity_adapt_first_nonblank": lambda spark, d: rows(spark, d, ADAPT).select("o_orderkey", names.first_non_blank("repository", "repo", "repo_name").alias("repository"), names.confidence("confidence", "score").alias("confidence")),
    "confidence_clamp": lambda spark, d: rows(spark, d, "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 25 - 0.5 END AS c FROM @lineitem").select("l_orderkey", "l_linenumber", names.clamp_confidence(F.col("c")).alias("c")),
    "entity_merge": lambda spark, d: merged(spark, d).select("canonical_id", "type", joined("aliases").alias("aliases"), "n_sources", "confidence"),
    "dedup_exact_alias": lambda spark, d: entities.exact_alias_links(rows(spark, d, TWINS)),
    "dedup_domain": lambda spark, d: entities.domain_links(rows(spark, d, TWINS)),
    "dedup_name_similarity": similar,
    "dedup_cosine": vector_pairs,
    "dedup_embedding_links": near_vectors,
    "dedup_components": lambda spark, d: components.connected_components(links(spark, d), "left", "right"),
    "dedup_merge": lambda spark, d: dedup(spark, d).select("id", "type", joined("aliases").alias("aliases"), "n_sources", "confidence", joined("members").alias("members")),
    "rel_key_normalise": lambda spark, d: rows(spark, d, RAW).select("pos", names.relation_key(F.col("relation")).alias("result")),
    "rel_type_map": lambda spark, d: rows(spark, d, RAW).select("pos", names.canonical_relation(F.col("relation")).alias("result")),
    "rel_alias_lookup": lambda spark, d: entities.last_of_name(rows(spark, d, NODES)),
    "rel_uuid5": lambda spark, d: rows(spark, d, NAMES).select("pos", names.uuid5(F.concat(F.lit("graph:entity:"), "name")).alias("id")),
    "rel_normalise": lambda spark, d: edges(spark, d).select("pos", "source", "target", "type", "id"),
    "rel_edge_merge": lambda spark, d: relationships.merge_edges(edges(spark, d)).withColumn("original_types", joined("original_types")),
    "rel_infer_parser": lambda spark, d: relationships.infer_parser(rows(spark, d, SHAPES)).select("o_orderkey", "parser"),
    "graph_semi_join_edges": lambda spark, d: existing(spark, d).select("id", "source", "target", "type"),
    "graph_upsert": lambda spark, d: relationships.upsert(rows(spark, d, OLD_NODES), rows(spark, d, NEW_NODES)),
    "graph_stats": lambda spark, d: relationships.graph_statistics(rows(spark, d, NODES).withColumn("confidence", F.lit(1.0)), relationships.merge_edges(edges(spark, d))),
    "graph_duplicate_ids": lambda spark, d: rows(spark, d, RAW).groupBy("source").agg(F.count("*").alias("n")).where("n > 1"),
}


def d_rule(expression: str) -> str:
    return f"SELECT pos, {expression} AS result FROM ({D_NAMES})"


ORACLES = {
    "rule_pascal_case": d_rule(d_pascal("name")),
    "rule_abbreviation": d_rule(d_abbreviations("name")),
    "rule_source_pattern_java": d_rule(d_java("name")),
    "rule_source_pattern_openapi": d_rule(d_resource("name")),
    "rule_source_pattern": d_rule(d_source("name", "source_parser")),
    "rule_synonym": d_rule(duck_map(D_SYNONYM, f"lower({d_pascal('name')})")),
    "rule_type_map": d_rule(d_type("type")),
    "rule_chain_canonical_id": f"SELECT pos, canonical_id, canonical_type FROM ({D_CANONICAL})",
    "entity_adapt_first_nonblank": f"SELECT o_orderkey, coalesce(nullif(trim(repository), ''), nullif(trim(repo), ''), nullif(trim(repo_name), '')) AS repository, coalesce(CASE WHEN try_cast(confidence AS DOUBLE) BETWEEN 0 AND 1 THEN CAST(confidence AS DOUBLE) END, CASE WHEN try_cast(score AS DOUBLE) BETWEEN 0 AND 1 THEN CAST(score AS DOUBLE) END, 1.0) AS confidence FROM ({duck(ADAPT)})",
    "confidence_clamp": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 OR l_quantity / 25 - 0.5 = 0 THEN 1.0::DOUBLE ELSE least(greatest(l_quantity / 25 - 0.5, 0.0), 1.0) END AS c FROM lineitem",
    "entity_merge": f"SELECT canonical_id, type, array_to_string({D_ORDERED_DISTINCT.format(l='all_names')}, '|') AS aliases, n_sources, confidence FROM ({D_MERGED})",
    "dedup_exact_alias": d_links(D_KEYS, "1.0::DOUBLE", "exact_alias"),
    "dedup_domain": d_links(D_DOMAIN_KEYS, "0.96::DOUBLE", "domain_mapping"),
    "dedup_cosine": "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "dedup_components": D_COMPONENTS,
    "dedup_embedding_links": _REACHED.replace("LINKS", D_NEAR),
    "dedup_merge": f"""
SELECT w.id AS id, w.type AS type, array_to_string({D_ORDERED_DISTINCT.format(l='every')}, '|') AS aliases, CAST(n_sources AS BIGINT) AS n_sources, confidence, array_to_string(members, '|') AS members FROM (
  SELECT arg_max(struct_pack(id := id, type := type), struct_pack(a := confidence, b := n_sources, c := id)) AS w, flatten(list(list_prepend(id, aliases) ORDER BY id)) AS every, sum(n_sources) AS n_sources, {D_MEAN.format(c='confidence')} AS confidence, list(id ORDER BY id) AS members
  FROM ({D_TWINS}) t LEFT JOIN ({D_COMPONENTS}) k ON k.node = t.id GROUP BY coalesce(component, id))""",
    "rel_key_normalise": f"SELECT pos, {d_relation_key('relation')} AS result FROM ({duck(RAW)})",
    "rel_type_map": f"SELECT pos, {d_relation('relation')} AS result FROM ({duck(RAW)})",
    "rel_alias_lookup": D_INDEX,
    "rel_uuid5": f"""SELECT pos, {d_uuid("'graph:entity:' || name")} AS id FROM ({D_NAMES})""",
    "rel_normalise": f"SELECT pos, source, target, type, id FROM ({D_EDGES})",
    "rel_edge_merge": f"SELECT * REPLACE (array_to_string(original_types, '|') AS original_types) FROM ({D_MERGED_EDGES})",
    "rel_infer_parser": f"SELECT o_orderkey, {D_SHAPE} AS parser FROM ({duck(SHAPES)})",
    "graph_semi_join_edges": f"SELECT id, source, target, type FROM ({D_MERGED_EDGES}) e WHERE source IN (SELECT id FROM ({D_NODES})) AND target IN (SELECT id FROM ({D_NODES}))",
    "graph_upsert": f"SELECT coalesce(b.id, a.id) AS id, coalesce(b.name, a.name) AS name, coalesce(b.label, a.label) AS label, coalesce(b.note, a.note) AS note FROM ({duck(OLD_NODES)}) a FULL JOIN ({duck(NEW_NODES)}) b ON a.id = b.id",
    "graph_stats": f"SELECT kind, type, count(*) AS n, max(confidence) AS max_confidence FROM (SELECT 'node' AS kind, type, 1.0::DOUBLE AS confidence FROM ({D_NODES}) UNION ALL SELECT 'edge', type, confidence FROM ({D_MERGED_EDGES})) GROUP BY GROUPING SETS ((kind, type), (kind))",
    "graph_duplicate_ids": f"SELECT source, count(*) AS n FROM ({duck(RAW)}) GROUP BY source HAVING count(*) > 1",
}
