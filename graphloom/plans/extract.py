"""Queries of versions, metadata, cleaning, vocabulary, model answers, embeddings, acquisition and resources."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import names, tables, versions
from graphloom.functions.checkpoints import checkpoint
from graphloom.operators import cleaning, entities, extraction, markdown, resources
from graphloom.plans.base import duck, duck_map, quoted, rows, table

VERSIONS = """SELECT o_orderkey AS k, CASE o_orderkey % 9 WHEN 0 THEN 'see PSD2 v1.3.' || CAST(o_orderkey % 50 AS STRING) || ' now' WHEN 1 THEN 'the Berlin  Group V2' WHEN 2 THEN 'NextGenPSD2 1.3' WHEN 3 THEN 'OpenAPI: 3.0.1 and V9'
  WHEN 4 THEN 'since v2.' || CAST(o_orderkey % 7 AS STRING) WHEN 5 THEN 'API V3 only' WHEN 6 THEN 'at 1.2.3 or 4' WHEN 7 THEN o_orderpriority ELSE NULL END AS text,
  CASE o_orderkey % 8 WHEN 0 THEN 'api/v2/spec.yml' WHEN 1 THEN 'psd2_1_' || CAST(o_orderkey % 4 AS STRING) || '_6_x.md' WHEN 2 THEN 'lib-1.' || CAST(o_orderkey % 6 AS STRING) || '/a' WHEN 3 THEN '1_0' WHEN 4 THEN 'V3.1 x' ELSE 'plain' END AS path,
  CASE o_orderkey % 5 WHEN 0 THEN ' v1.' || CAST(o_orderkey % 3 AS STRING) WHEN 1 THEN 'v' END AS given FROM @orders"""
FILES = """SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'psd2_implementation_guidelines_v1.3_clean' WHEN 1 THEN 'xs2a_operational_RULES_1_3_2_final' WHEN 2 THEN lower(c_mktsegment) || '_api_spec_draft_v2' WHEN 3 THEN 'Reference_' || lower(c_mktsegment) WHEN 4 THEN 'json_v2_v1' ELSE 'manual_V1.4' END AS stem,
  concat_ws(chr(10), CASE WHEN c_custkey % 3 = 0 THEN '  #  [' || c_name || '](x.md) Guide ' END, CASE c_custkey % 4 WHEN 0 THEN 'Version: 1.' || CAST(c_custkey % 9 AS STRING) || '.1' WHEN 1 THEN 'Release 2.0' WHEN 2 THEN 'v. 3.5' END,
    CASE c_custkey % 5 WHEN 0 THEN 'The Berlin Group' WHEN 1 THEN 'made by Acme Corp of' WHEN 2 THEN 'EBA' END, CASE c_custkey % 7 WHEN 0 THEN 'Published: 2024-01-02' WHEN 1 THEN 'Date 2023-05-06' WHEN 2 THEN 'on 01/02/2022' WHEN 3 THEN '2021/03/04' END, c_mktsegment) AS text,
  map('version', CASE WHEN c_custkey % 11 = 0 THEN '7.7' ELSE ' ' END) AS frontmatter FROM @customer"""
D_FILES = duck(FILES).replace("map('version', CASE", "map(['version'], [CASE").replace("ELSE ' ' END) AS", "ELSE ' ' END]) AS")
DIRTY = """SELECT s_suppkey AS doc_id, '## 1.' || CAST(s_suppkey % 4 AS STRING) || '.2.3.4 Deep' || chr(10) || '# 3 Top' || chr(10) || 'ACME Corp  ' || chr(10) || 'a line that' || chr(10) || 'goes on.' || chr(10) || '<!-- image -->' || chr(10) || ' ACME Corp' || chr(10) || 'Page 1 of 9' || chr(10) || '- 7 -' || chr(10) || CAST(s_suppkey AS STRING) || chr(10) || 'Ends:' || chr(10) || 'small' || chr(10) || '<!--image-->' || chr(10) ||
  CASE WHEN s_suppkey % 3 <> 0 THEN 'ACME Corp' || chr(10) ELSE '' END || '| A | B |' || chr(10) || '|---|---|' || chr(10) || '| 1 | One ..... 3 |' || chr(10) || '| 1.1 | Two ..... ' || CAST(s_suppkey % 50 AS STRING) || ' |' || chr(10) || CASE WHEN s_suppkey % 2 = 0 THEN '| | Three ...... 9 |' || chr(10) ELSE '' END || '| x | y |' || chr(10) || 'End' AS text FROM @supplier"""
D_DIRTY = duck(DIRTY)
ANSWERS = """SELECT conv_id * 1000 + turn AS source_id, CASE turn % 5 WHEN 0 THEN '```json' || chr(10) WHEN 1 THEN 'Here: ```' ELSE '' END ||
  CASE WHEN turn % 5 = 3 THEN 'sorry, none' ELSE '{"entities": [{"type": "Class", "name": " E' || CAST(conv_id % 9 AS STRING) || ' "}, {"name": "Other"}, {"name": " "}, {"type": "", "name": "OTHER", "label": "L"}], "relationships": [{"source": "e' || CAST(conv_id % 9 AS STRING) || '", "target": "other", "type": "uses", "confidence": 0.5}, {"source": "OTHER", "target": "E' || CAST(conv_id % 9 AS STRING) || '", "type": "Calls"}, {"source": "e' || CAST(conv_id % 9 AS STRING) || '", "target": "Other", "type": "USES", "confidence": 7}, {"source": "gone", "target": "other", "type": "x"}]}' END ||
  CASE WHEN turn % 5 < 2 THEN chr(10) || '``` bye' ELSE '' END AS answer FROM @conversations"""
D_BODY = "CASE WHEN regexp_extract(answer, '(?s)```(?:json)?\\s*(.*?)```', 1) <> '' THEN trim(regexp_extract(answer, '(?s)```(?:json)?\\s*(.*?)```', 1), ' ' || chr(10)) ELSE trim(answer) END"
D_PARSED = f"SELECT source_id, CASE WHEN starts_with(b, '{{') THEN b END AS j, CASE WHEN NOT starts_with(b, '{{') THEN 'not a JSON object' END AS error FROM (SELECT source_id, {D_BODY} AS b FROM ({duck(ANSWERS)}))"
D_ENTITIES = f"SELECT source_id, CAST(k - 1 AS INTEGER) AS pos, trim(e ->> '$.name') AS name, coalesce(nullif(e ->> '$.type', ''), 'entity') AS type, coalesce(nullif(e ->> '$.label', ''), 'UNKNOWN') AS label FROM (SELECT source_id, k, es[k] AS e FROM (SELECT source_id, es, unnest(range(1, len(es) + 1)) AS k FROM (SELECT source_id, CAST(j::JSON -> '$.entities' AS JSON[]) AS es FROM ({D_PARSED}) WHERE j IS NOT NULL))) WHERE trim(e ->> '$.name') <> ''"
D_INDEX = f"SELECT source_id, lower(name) AS key, max_by(name, pos) AS name FROM ({D_ENTITIES}) GROUP BY ALL"
D_RELATIONS = f"""SELECT r.source_id, CAST(k - 1 AS INTEGER) AS pos, s.name AS source, t.name AS target, r.e ->> '$.type' AS type, least(greatest(coalesce(CAST(r.e ->> '$.confidence' AS DOUBLE), 1.0), 0.0), 1.0) AS confidence FROM (SELECT source_id, k, es[k] AS e FROM (SELECT source_id, es, unnest(range(1, len(es) + 1)) AS k FROM (SELECT source_id, CAST(j::JSON -> '$.relationships' AS JSON[]) AS es FROM ({D_PARSED}) WHERE j IS NOT NULL))) r
  JOIN ({D_INDEX}) s ON s.source_id = r.source_id AND s.key = lower(trim(r.e ->> '$.source')) JOIN ({D_INDEX}) t ON t.source_id = r.source_id AND t.key = lower(trim(r.e ->> '$.target'))"""
WORDS = {"the": ["and", "of"], "de": ["la", "el"], "und": ["der", "die"], "le": ["les"]}
_FORMS = {a: t for t, others in WORDS.items() for a in [t, *others]}
RESOURCES = """SELECT 'r' || CAST(k % 3 AS STRING) AS repository, path, text FROM (
  SELECT p_partkey AS k, 'mod' || CAST(p_size % 5 AS STRING) || '/' || CASE p_size % 3 WHEN 0 THEN 'sub/' ELSE '' END || CASE p_partkey % 5 WHEN 0 THEN 'target/' ELSE 'src/' END || 'f' || CAST(p_partkey AS STRING) || '.properties' AS path,
    '# comment' || chr(10) || 'a.name = ' || p_name || ' ' || chr(10) || 'b:x' || CAST(p_size AS STRING) || chr(10) || 'long=one,' || chr(92) || chr(10) || '   two' || chr(10) || '!no' || chr(10) || 'a.name=' || p_brand || chr(10) || 'flag' AS text FROM @part
  UNION ALL SELECT p_partkey, 'mod' || CAST(p_size % 5 AS STRING) || '/c' || CAST(p_partkey AS STRING) || '.yml', 'server: {port: ' || CAST(p_size AS STRING) || ', hosts: [a, b]}' || chr(10) || 'name: "' || p_name || '"' || chr(10) || '---' || chr(10) || 'extra: true' || chr(10) || 'none:' FROM @part WHERE p_partkey % 3 = 0
  UNION ALL SELECT p_partkey, 'mod' || CAST(p_partkey AS STRING) || '/pom.xml', '<?xml version="1.0"?><project xmlns="http://m"><parent><groupId>g' || CAST(p_size AS STRING) || '</groupId><version>1.' || CAST(p_size AS STRING) || '</version></parent><artifactId>a' || CAST(p_partkey AS STRING) || '</artifactId>' || CASE WHEN p_size % 2 = 0 THEN '<version> 2 </version>' ELSE '' END || '<modules><module>sub</module><module>gone</module></modules><dependencies><dependency><groupId>x</groupId><artifactId>d1</artifactId></dependency><dependency><artifactId>d2</artifactId></dependency></dependencies><properties><java.version>' || CAST(p_size AS STRING) || '</java.version><empty/></properties><build><plugins><plugin><groupId>p</groupId><artifactId>shade</artifactId></plugin></plugins></build></project>' FROM @part
  UNION ALL SELECT p_partkey, 'mod' || CAST(p_partkey + p_partkey % 2 AS STRING) || '/build.gradle', 'group = "g' || CAST(p_size AS STRING) || '"' || chr(10) || 'dependencies { implementation("a:b:1") ' || chr(10) || 'api "c:d:2" }' FROM @part
  UNION ALL SELECT p_partkey, 'src/main/java/q/P' || CAST(p_partkey AS STRING) || '.java', '// x' || chr(10) || ' package q.p' || CAST(p_size AS STRING) || ';' || chr(10) || 'class P { }' || CASE WHEN p_size % 2 = 0 THEN chr(10) ELSE '' END FROM @part WHERE p_partkey % 2 = 0
  UNION ALL SELECT p_partkey, 'lib/com/acme/Q' || CAST(p_partkey AS STRING) || '.java', 'package com.acme;' FROM @part WHERE p_partkey % 7 = 0
  UNION ALL SELECT p_partkey, 'db/' || CAST(p_partkey AS STRING) || '.xml', CASE WHEN p_size % 2 = 0 THEN '<databaseChangeLog xmlns="u"><changeSet id="c' || CAST(p_size AS STRING) || '"/></databaseChangeLog>' ELSE '<b:beans xmlns:b="u"><b:bean id="x"/><b:bean id="y"/></b:beans>' END FROM @part WHERE p_partkey % 11 = 0)"""
D_RESOURCES = duck(RESOURCES)
MODULES = """SELECT DISTINCT 'r' || CAST(p_partkey % 3 AS STRING) AS repository, 'mod' || CAST(p_size % 4 AS STRING) || CASE WHEN p_size % 2 = 0 THEN '/sub' ELSE '' END AS module FROM @part"""
LINKS = """SELECT page_id AS k, CASE WHEN page_id % 5 = 0 THEN ' ' ELSE ' Guide V1.' || CAST(page_id % 3 AS STRING) || '.' || CAST(page_id AS STRING) || ' 2.0 ' END AS title, CASE WHEN page_id % 7 = 0 THEN '' ELSE url || '/files/doc' || CAST(page_id AS STRING) || '.pdf?x=1' END AS href FROM @pages"""


def repository(spark, d):
    return rows(spark, d, RESOURCES)


def parsed(spark, d):
    return extraction.answers(rows(spark, d, ANSWERS))


def found(spark, d):
    return extraction.answer_entities(parsed(spark, d))


def relations(spark, d):
    return extraction.answer_relationships(parsed(spark, d), found(spark, d))


VECTORS = "SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN embedding END AS embedding, CASE WHEN vec_id % 2 = 0 THEN embedding END AS embeddings, embedding AS vector FROM @embeddings"


def summary(spark, d):
    answers, known = parsed(spark, d), checkpoint(found(spark, d))
    related = checkpoint(extraction.answer_relationships(answers, known))
    return extraction.summary(answers, known, related, extraction.triples(related))


def version_columns(spark, d):
    content = versions.content_version(F.col("text"))
    v = versions.version_with_source(F.col("given"), [F.col("path")], content)
    return rows(spark, d, VERSIONS).withColumn("v", v).select("k", "v.version", "v.source")


def links(spark, d):
    """Rows with a title and an address; the file's name is the last part of the address's path."""
    out = rows(spark, d, LINKS).withColumn("title", names.strip(F.col("title"))).withColumn("href", names.strip(F.col("href"))).where("title <> '' AND href <> ''")
    return out.select("k", F.regexp_extract("href", r"^[^?#]*/([^/?#]+)", 1).alias("filename"), versions.link_version(F.col("title")).alias("version"), versions.link_version(F.col("title"), True).alias("trailing_version"))


def specification(spark, d):
    made = versions.specification_metadata(F.col("frontmatter"), F.col("stem"), F.col("text"))
    return rows(spark, d, FILES, customer="c_custkey").select("k", *[c.alias(n) for n, c in made.items()])


def dirty(column):
    return lambda spark, d: rows(spark, d, DIRTY, supplier="s_suppkey").select("doc_id", column(F.col("text")).alias("text"))


def joined(c):
    return F.array_join(c, "|").alias(c)


QUERIES = {
    "ex_version_content": lambda spark, d: rows(spark, d, VERSIONS).withColumn("v", versions.content_version(F.col("text"))).select("k", "v.version", "v.rule"),
    "ex_version_path": lambda spark, d: rows(spark, d, VERSIONS).select("k", versions.path_version(F.col("path")).alias("version")),
    "ex_version_priority": version_columns,
    "ex_version_path_parts": lambda spark, d: rows(spark, d, LINKS).select("k", versions.path_parts_version(F.concat_ws("/", F.lit("a 1.2"), "title", F.lit("x"))).alias("version")),
    "md_filename_meta": lambda spark, d: rows(spark, d, FILES, customer="c_custkey").withColumn("bare", versions.file_stem(F.col("stem"))).select("k", "bare", versions.file_version(F.col("bare")).alias("version"), versions.specification_name(F.col("bare")).alias("name"), versions.file_category(F.col("bare")).alias("category")),
    "md_content_meta": lambda spark, d: rows(spark, d, FILES, customer="c_custkey").select("k", versions.content_title(F.col("text")).alias("title"), versions.content_spec_version(F.col("text")).alias("version"), versions.content_organisation(F.col("text")).alias("organisation"), versions.content_date(F.col("text")).alias("published")),
    "md_spec_meta": specification,
    "ex_vocabulary": lambda spark, d: extraction.vocabulary_matches(table(spark, d, "documents"), WORDS, "WORD").select("doc_id", "form", "name", "n", "term"),
    "ex_llm_parse": lambda spark, d: parsed(spark, d).select("source_id", "error", F.coalesce(F.size("a.entities"), F.lit(0)).alias("n_entities")),
    "ex_llm_entities": found,
    "ex_rel_resolve": relations,
    "ex_triples_dedup": lambda spark, d: extraction.triples(relations(spark, d)),
    "ex_summary": summary,
    "ex_first_records": lambda spark, d: extraction.first_records(table(spark, d, "pages").select("page_id", "url"), 20, "url", "page_id"),
    "dedup_embedding_pick": lambda spark, d: rows(spark, d, VECTORS).select("vec_id", entities.pick_embedding("embedding", "embeddings", "vector").alias("v")).select("vec_id", F.size("v").alias("n"), F.round(F.get("v", F.lit(0)).cast("double"), 6).alias("first")),
    "ex_embed_text": lambda spark, d: table(spark, d, "part").select("p_partkey", extraction.embedding_text(F.col("p_type"), F.col("p_name"), F.lit(""), F.col("p_brand")).alias("text"), extraction.input_type(F.when(F.col("p_size") % 2 == 0, F.lit("Method")).otherwise(F.col("p_type"))).alias("input_type")),
    "ex_embed_batches": lambda spark, d: extraction.embed(table(spark, d, "part").select("p_partkey", F.col("p_name").alias("text"))).select("p_partkey", F.size("vector").alias("dimension"), F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm")),
    "ex_final_errors": lambda spark, d: rows(spark, d, "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Input TOO LONG' WHEN event_id % 3 = 1 THEN 'HTTP 400 ' || event_type ELSE 'timeout' END AS message FROM @events").select("event_id", extraction.is_final_error(F.col("message")).alias("final")),
    "clean_noise_lines": lambda spark, d: cleaning.noise_lines(markdown.lines(rows(spark, d, DIRTY, supplier="s_suppkey"))),
    "clean_without_noise": dirty(cleaning.without_noise),
    "clean_relevel": dirty(cleaning.relevel),
    "clean_page_numbers": dirty(cleaning.without_page_numbers),
    "clean_images": dirty(cleaning.number_images),
    "clean_toc": dirty(cleaning.contents_list),
    "clean_all": lambda spark, d: cleaning.cleaned(rows(spark, d, DIRTY, supplier="s_suppkey")).select("doc_id", "text"),
    "ingest_link_version": links,
    "ingest_anti_join": lambda spark, d: links(spark, d).join(rows(spark, d, LINKS).where("k % 3 = 0").select("k"), "k", "left_anti").select("k", "filename"),
    "ingest_html_links": lambda spark, d: table(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "href")),
    "safe_name": lambda spark, d: rows(spark, d, LINKS).select("k", names.safe_name(F.col("title")).alias("safe"), names.file_slug(F.col("title")).alias("slug")),
    "summary_rollup": lambda spark, d: table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 25).alias("large"), F.countDistinct("l_suppkey").alias("suppliers")),
    "res_inventory": lambda spark, d: resources.inventory(repository(spark, d)),
    "res_build_systems": lambda spark, d: resources.build_systems(repository(spark, d)).where("build_system <> 'unknown'"),
    "res_pom": lambda spark, d: resources.maven(repository(spark, d)).withColumn("modules", joined("modules")).withColumn("dependencies", joined("dependencies")).withColumn("plugins", joined("plugins")).withColumn("properties", F.array_join(F.transform(F.array_sort(F.map_entries("properties")), lambda e: F.concat_ws("=", e["key"], e["value"])), "|")),
    "res_gradle": lambda spark, d: resources.gradle(repository(spark, d)).withColumn("modules", joined("modules")).withColumn("dependencies", joined("dependencies")),
    "res_modules": lambda spark, d: resources.modules(rows(spark, d, MODULES).groupBy("repository").agg(F.collect_list("module").alias("modules")), repository(spark, d)),
    "res_module_prefix_join": lambda spark, d: resources.resources(repository(spark, d), rows(spark, d, MODULES)),
    "res_properties": lambda spark, d: resources.properties(repository(spark, d).where("path LIKE '%.properties'")),
    "res_yaml_flatten": lambda spark, d: resources.yaml_entries(repository(spark, d).where("path LIKE '%.yml'")),
    "res_xml": lambda spark, d: resources.xml_files(repository(spark, d).where("path LIKE '%.xml'")).withColumn("change_sets", joined("change_sets")).withColumn("beans", joined("beans")).drop("children"),
    "res_summary": lambda spark, d: resources.resource_summary(resources.resources(repository(spark, d), rows(spark, d, MODULES))),
}


def d_extract(text: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({text}, {quoted(pattern)}, {group}), '')"


def d_path(c: str) -> str:
    parts = []
    for pattern, groups in tables.PATH_VERSIONS:
        numbers = ", ".join(d_extract(c, pattern, k) for k in range(1, groups + 1))
        parts.append(f"CASE WHEN {d_extract(c, pattern)} IS NOT NULL THEN 'v' || concat_ws('.', {numbers}) END")
    return f"coalesce({', '.join(parts)})"


D_CONTENT = "coalesce(" + ", ".join(f"'v' || {d_extract('text', p)}" for _, p in tables.CONTENT_VERSIONS) + ")"
D_RULE = "CASE " + " ".join(f"WHEN {d_extract('text', p)} IS NOT NULL THEN '{n}'" for n, p in tables.CONTENT_VERSIONS) + " END"
D_GIVEN = "'v' || nullif(ltrim(trim(given), 'vV'), '')"
D_STEM = "stem"
for _s in tables.FILE_SUFFIXES:
    D_STEM = f"regexp_replace({D_STEM}, '(?i){_s}$', '')"
D_FVERSION = f"replace(coalesce({d_extract('bare', '(?i)_v?([0-9]+[._][0-9]+(?:[._][0-9]+)?)')}, {d_extract('bare', '(?i)v([0-9]+[._][0-9]+(?:[._][0-9]+)?)')}), '_', '.')"
D_FNAME = f"nullif(array_to_string(list_transform(list_filter(string_split(replace(CASE WHEN {D_FVERSION} IS NULL THEN bare ELSE regexp_replace(bare, '(?i)_v?\\d+[._]\\d+[._]?\\d*', '', 'g') END, '_', ' '), ' '), lambda w: w <> ''), lambda w: CASE WHEN lower(w) IN ({', '.join(map(quoted, tables.FILE_ACRONYMS))}) THEN upper(w) ELSE upper(w[1]) || lower(w[2:]) END), ' '), '')"
D_FCATEGORY = "CASE " + " ".join(f"WHEN contains(lower(bare), '{w}') THEN '{c}'" for w, c in tables.FILE_CATEGORIES) + " END"
D_NAMED = f"SELECT *, {D_FVERSION} AS fversion, {D_FNAME} AS fname, {D_FCATEGORY} AS fcategory FROM (SELECT *, {D_STEM} AS bare FROM ({D_FILES}))"
D_TITLE = f"nullif(regexp_replace(trim(regexp_extract(text, '(?m)^[ \\t]*# +(\\S.*)$', 1)), '\\[([^\\]]+)\\]\\([^\\)]+\\)', '\\1', 'g'), '')"
D_SPECV = "coalesce(" + ", ".join(d_extract("text", p) for p in (r"[Vv]ersion[:\s]+(\d+\.\d+(?:\.\d+)?)", r"[Vv]\.?\s*(\d+\.\d+(?:\.\d+)?)", r"Release\s+(\d+\.\d+(?:\.\d+)?)")) + ")"
D_ORG = "coalesce(CASE " + " ".join(f"WHEN contains(text, '{o}') THEN '{o}'" for o in tables.ORGANISATIONS) + " END, " + d_extract("text", r"[Bb]y\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)") + ")"
D_DATE = "coalesce(" + ", ".join(d_extract("text", p) for p in (r"[Pp]ublished[:\s]+(\d{4}-\d{2}-\d{2})", r"[Pp]ublication [Dd]ate[:\s]+(\d{4}-\d{2}-\d{2})", r"[Dd]ate[:\s]+(\d{4}-\d{2}-\d{2})", r"(\d{2}/\d{2}/\d{4})", r"(\d{4}/\d{2}/\d{2})")) + ")"
D_DLINES = f"SELECT doc_id, k, ls[k] AS raw, trim(ls[k]) AS text FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM ({D_DIRTY})))"
D_NOISE = f"SELECT doc_id, text, count(*) AS n FROM ({D_DLINES}) WHERE text <> '' GROUP BY ALL HAVING count(*) >= 3 AND length(text) < 120"
D_LINKS = f"SELECT k, regexp_extract(href, '^[^?#]*/([^/?#]+)', 1) AS filename, coalesce({d_extract('title', '(?i)V([0-9]+[.][0-9]+(?:[.][0-9]+)*)')}, 'unknown') AS version, coalesce({d_extract('title', '([0-9]+[.][0-9]+(?:[.][0-9]+)*)[ ]*$')}, 'unknown') AS trailing_version FROM (SELECT k, trim(title) AS title, trim(href) AS href FROM ({duck(LINKS)})) WHERE title <> '' AND href <> ''"
D_TRIPLES = f"SELECT source_id, source AS subject, predicate, target AS object, confidence FROM (SELECT *, row_number() OVER (PARTITION BY source_id, lower(source), predicate, lower(target) ORDER BY confidence DESC, pos) AS r FROM (SELECT *, upper(type) AS predicate FROM ({D_RELATIONS}))) WHERE r = 1"
D_FOLDER = "regexp_replace(path, '/?[^/]*$', '')"
D_USED = f"SELECT repository, path, CASE regexp_extract(path, '(\\.[^./]+)$', 1) WHEN '.properties' THEN 'properties' WHEN '.yml' THEN 'yaml' WHEN '.xml' THEN 'xml' END AS kind FROM ({D_RESOURCES}) WHERE kind IS NOT NULL AND NOT list_has_any(string_split(path, '/'), ['target', 'build'])"
D_MODULED = f"SELECT repository, path, kind, coalesce((SELECT max_by(m.module, length(m.module)) FROM ({duck(MODULES)}) m WHERE m.repository = u.repository AND starts_with(u.path, m.module || '/')), 'root') AS module FROM ({D_USED}) u"
_ROWS = f"SELECT repository, path, k, trim(ls[k]) AS raw FROM (SELECT repository, path, ls, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT repository, path, string_split(regexp_replace(text, '\\\\\\n[ ]*', '', 'g'), chr(10)) AS ls FROM ({D_RESOURCES}) WHERE path LIKE '%.properties')) WHERE trim(ls[k]) <> '' AND NOT regexp_matches(trim(ls[k]), '^[#!]')"

ORACLES = {
    "ex_version_content": f"SELECT k, {D_CONTENT} AS version, {D_RULE} AS rule FROM ({duck(VERSIONS)})",
    "ex_version_path": f"SELECT k, {d_path('path')} AS version FROM ({duck(VERSIONS)})",
    "ex_version_priority": f"SELECT k, coalesce({D_GIVEN}, {d_path('path')}, {D_CONTENT}) AS version, CASE WHEN {D_GIVEN} IS NOT NULL THEN 'metadata' WHEN {d_path('path')} IS NOT NULL THEN 'source_path' WHEN {D_CONTENT} IS NOT NULL THEN 'content:' || {D_RULE} END AS source FROM ({duck(VERSIONS)})",
    "ex_version_path_parts": f"SELECT k, coalesce({d_extract('title', '\\b([0-9]+[.][0-9]+(?:[.][0-9]+)*)\\b')}, '1.2') AS version FROM ({duck(LINKS)})",
    "md_filename_meta": f"SELECT k, bare, fversion AS version, fname AS name, fcategory AS category FROM ({D_NAMED})",
    "md_content_meta": f"SELECT k, {D_TITLE} AS title, {D_SPECV} AS version, {D_ORG} AS organisation, {D_DATE} AS published FROM ({D_FILES})",
    "md_spec_meta": f"SELECT k, coalesce(fname, {D_TITLE}, 'unknown') AS name, coalesce(nullif(trim(frontmatter['version']), ''), fversion, {D_SPECV}, 'unknown') AS version, coalesce(fcategory, 'unknown') AS category, coalesce({D_ORG}, 'unknown') AS organisation, coalesce({D_DATE}, 'unknown') AS published FROM ({D_NAMED})",
    "ex_vocabulary": f"SELECT doc_id, form, min_by(w, pos) AS name, count(*) AS n, {duck_map(_FORMS, 'form')} AS term FROM (SELECT doc_id, pos, ws[pos] AS w, lower(ws[pos]) AS form FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '{extraction.WORD}') AS ws FROM documents))) WHERE form IN ({', '.join(map(quoted, _FORMS))}) GROUP BY doc_id, form",
    "ex_llm_parse": f"SELECT source_id, error, CASE WHEN error IS NULL THEN 4 ELSE 0 END AS n_entities FROM ({D_PARSED})",
    "ex_llm_entities": D_ENTITIES,
    "ex_rel_resolve": D_RELATIONS,
    "ex_triples_dedup": D_TRIPLES,
    "ex_summary": f"SELECT (SELECT count(*) FROM ({D_PARSED})) AS n_records, (SELECT count(error) FROM ({D_PARSED})) AS n_failed, (SELECT count(*) FROM ({D_ENTITIES})) AS n_entities, (SELECT count(*) FROM ({D_RELATIONS})) AS n_relationships, (SELECT count(*) FROM ({D_TRIPLES})) AS n_triples",
    "ex_first_records": "SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 20",
    "dedup_embedding_pick": "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM embeddings",
    "ex_embed_text": "SELECT p_partkey, p_type || ': ' || p_name || ' ' || p_brand AS text, CASE WHEN p_size % 2 = 0 THEN 'JAVA_METHOD' ELSE 'ENTITY' END AS input_type FROM part",
    "ex_embed_batches": "SELECT p_partkey, 64 AS dimension, 1.0::DOUBLE AS norm FROM part",
    "ex_final_errors": "SELECT event_id, event_id % 3 < 2 AS final FROM events",
    "clean_noise_lines": D_NOISE,
    "clean_without_noise": f"SELECT l.doc_id, string_agg(raw, chr(10) ORDER BY k) AS text FROM ({D_DLINES}) l ANTI JOIN ({D_NOISE}) n ON n.doc_id = l.doc_id AND n.text = l.text GROUP BY l.doc_id",
    "clean_relevel": f"SELECT doc_id, string_agg(CASE WHEN regexp_matches(raw, '^#{{1,6}} [0-9]+(\\.[0-9]+)* .') THEN repeat('#', least(len(string_split(string_split(raw, ' ')[2], '.')), 4)) || ' ' || array_to_string(string_split(raw, ' ')[2:], ' ') ELSE raw END, chr(10) ORDER BY k) AS text FROM ({D_DLINES}) GROUP BY doc_id",
    "clean_page_numbers": f"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(?m)^\\s*Page\\s+\\d+\\s+of\\s+\\d+\\s*$', '', 'g'), '(?m)^\\s*-\\s*\\d+\\s*-\\s*$', '', 'g'), '(?m)^\\s*\\d+\\s*$', '', 'g') AS text FROM ({D_DIRTY})",
    "clean_images": f"SELECT doc_id, replace(replace(text, '<!-- image -->', '*[Figure 1: diagram or image -- not extracted]*'), '<!--image-->', '*[Figure 2: diagram or image -- not extracted]*') AS text FROM ({D_DIRTY})",
    "clean_toc": f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, t, '- **1**  One -- p.3' || chr(10) || '  - **1.1**  Two -- p.' || doc_id % 50 || chr(10) || '- Three -- p.9' || chr(10) || '- x' || chr(10)) ELSE text END AS text FROM (SELECT doc_id, text, regexp_extract(text, '(?:\\|[^\\n]+\\|\\n)+') AS t FROM ({D_DIRTY}))""",
    "ingest_link_version": D_LINKS,
    "ingest_anti_join": f"SELECT k, filename FROM ({D_LINKS}) WHERE k % 3 <> 0",
    "ingest_html_links": "SELECT page_id, CAST(k - 1 AS INTEGER) AS pos, hs[k] AS href FROM (SELECT page_id, hs, unnest(range(1, len(hs) + 1)) AS k FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS hs FROM pages))",
    "safe_name": f"SELECT k, regexp_replace(title, '[^\\w-]', '_', 'g') AS safe, trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM ({duck(LINKS)})",
    "summary_rollup": "SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_quantity > 25) AS large, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "res_inventory": f"SELECT repository, path, regexp_extract(text, '(?m)^\\s*package\\s+([\\w.]+)\\s*;', 1) AS package, CAST(len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END AS INTEGER) AS n_lines, CASE WHEN starts_with(path, 'src/main/java/') THEN 'src/main/java' ELSE 'lib' END AS source_root FROM ({D_RESOURCES}) WHERE path LIKE '%.java'",
    "res_build_systems": f"SELECT repository, {D_FOLDER} AS directory, CASE WHEN bool_or(path LIKE '%pom.xml') THEN 'maven' ELSE 'gradle' END AS build_system FROM ({D_RESOURCES}) WHERE path LIKE '%/pom.xml' OR path LIKE '%/build.gradle' GROUP BY ALL",
    "res_pom": f"SELECT repository, path, regexp_extract(text, '<parent><groupId>(.*?)</groupId>', 1) AS group_id, regexp_extract(text, '</parent><artifactId>(.*?)</artifactId>', 1) AS artifact_id, CASE WHEN contains(text, '<version> 2 ') THEN '2' ELSE regexp_extract(text, '<version>(.*?)</version>', 1) END AS version, 'jar' AS packaging, 'sub|gone' AS modules, 'd1|d2' AS dependencies, 'shade' AS plugins, 'empty=|java.version=' || regexp_extract(text, '<java.version>(.*?)</java.version>', 1) AS properties FROM ({D_RESOURCES}) WHERE path LIKE '%/pom.xml'",
    "res_gradle": f"SELECT repository, path, regexp_extract(text, 'group = \"(.*?)\"', 1) AS group_id, NULL::VARCHAR AS version, 'a:b:1|c:d:2' AS dependencies, '' AS modules FROM ({D_RESOURCES}) WHERE path LIKE '%/build.gradle'",
    "res_modules": f"SELECT r.repository, coalesce(m.module, '') AS module FROM (SELECT DISTINCT repository FROM ({D_RESOURCES})) r LEFT JOIN (SELECT * FROM ({duck(MODULES)}) m WHERE EXISTS (SELECT 1 FROM ({D_RESOURCES}) f WHERE f.repository = m.repository AND starts_with(f.path, m.module || '/'))) m ON m.repository = r.repository",
    "res_module_prefix_join": D_MODULED,
    "res_properties": f"SELECT repository, path, trim(key) AS key, max_by(trim(value), k) AS value FROM (SELECT *, CASE WHEN contains(raw, '=') THEN string_split(raw, '=')[1] WHEN contains(raw, ':') THEN string_split(raw, ':')[1] ELSE raw END AS key, CASE WHEN contains(raw, '=') THEN raw[strpos(raw, '=') + 1:] WHEN contains(raw, ':') THEN raw[strpos(raw, ':') + 1:] ELSE '' END AS value FROM ({_ROWS})) GROUP BY repository, path, trim(key)",
    "res_yaml_flatten": f"SELECT repository, path, e.k AS key, e.v AS value FROM (SELECT repository, path, unnest([{{'k': 'server.port', 'v': regexp_extract(text, 'port: (.*?),', 1)}}, {{'k': 'server.hosts.0', 'v': 'a'}}, {{'k': 'server.hosts.1', 'v': 'b'}}, {{'k': 'name', 'v': regexp_extract(text, 'name: \"(.*)\"', 1)}}, {{'k': 'extra', 'v': 'true'}}, {{'k': 'none', 'v': NULL}}]) AS e FROM ({D_RESOURCES}) WHERE path LIKE '%.yml')",
    "res_xml": f"SELECT repository, path, CASE WHEN contains(text, '<project') THEN 'pom' WHEN contains(text, 'changeSet') THEN 'liquibase' ELSE 'spring' END AS kind, CASE WHEN contains(text, '<project') THEN 'project' WHEN contains(text, 'changeSet') THEN 'databaseChangeLog' ELSE 'beans' END AS root, CASE WHEN contains(text, 'changeSet') THEN regexp_extract(text, 'id=\"(.*?)\"', 1) ELSE '' END AS change_sets, CASE WHEN contains(text, 'beans') THEN 'x|y' ELSE '' END AS beans FROM ({D_RESOURCES}) WHERE path LIKE '%.xml'",
    "res_summary": f"SELECT repository, count(*) AS n, count(*) FILTER (kind = 'properties') AS n_properties, count(*) FILTER (kind = 'yaml') AS n_yaml, count(*) FILTER (kind = 'xml') AS n_xml, count(DISTINCT module) AS n_modules FROM ({D_MODULED}) GROUP BY repository",
}
