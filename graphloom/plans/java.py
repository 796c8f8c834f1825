"""Queries over Java sources that are written from the parts' rows; the oracle says what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import java as jv
from graphloom.plans.base import duck, rows

_K = "CAST(p_partkey AS STRING)"
#: What each part's file is made of.
FACTS = f"""SELECT p_partkey AS k, 'repo' || CAST(p_partkey % 2 AS STRING) AS repository, 'mod' || CAST(p_size % 3 AS STRING) AS module, 'src/P' || {_K} || '.java' AS path,
  CASE WHEN p_partkey % 9 = 0 THEN '' ELSE 'com.acme.p' || CAST(p_partkey % 5 AS STRING) END AS package, 'Part' || CAST(p_partkey % 700 AS STRING) AS name, 'Part' || CAST(p_size AS STRING) AS used,
  p_partkey % 4 AS shape, CASE p_size % 3 WHEN 0 THEN 'Service' WHEN 1 THEN 'RestController' ELSE 'Helper' END AS mark FROM @part"""
FILES = """SELECT repository, module, path, CASE WHEN package = '' THEN '' ELSE 'package ' || package || ';' || chr(10) END || 'import org.spring.' || mark || ';' || chr(10) || 'import java.util.*; // no import x.Y;' || chr(10) || '/* class Hidden { } */' || chr(10) ||
  CASE WHEN shape = 3 THEN 'interface ' || name || ' extends Base<' || used || '>, Other { default int one() { return 1; } }' ELSE
  '@' || mark || CASE WHEN mark = 'RestController' THEN ' @GetMapping("/p' || CAST(k AS STRING) || '")' ELSE '' END || ' public class ' || name || CASE WHEN shape = 1 THEN ' extends ' || used || '<String>' ELSE '' END || ' implements Comparable<' || name || '>, Api {' || chr(10) ||
  '  @Autowired private ' || used || ' dep, other; static int count = 0;' || chr(10) ||
  CASE WHEN shape < 2 THEN '  ' || name || '(' || used || ' a, final int n) { this.dep = a; }' || chr(10) ELSE '' END || CASE WHEN shape = 0 THEN '  ' || name || '() { }' || chr(10) ELSE '' END ||
  '  /** run( */ public List<String> run(int x, Map<String, Integer>... more) { String s = "call(1)"; helper(x); helper(x); dep.go(s); return Util.of(new Made(x)); }' || chr(10) || '  abstract void none();' || chr(10) || '}' END AS text FROM (FACTS)""".replace("FACTS", FACTS)
D = duck(FACTS)
FULL = "CASE WHEN package = '' THEN name ELSE package || '.' || name END"


def files(spark, d):
    return rows(spark, d, FILES, part="p_partkey")


def found(spark, d):
    return jv.types(jv.parse(files(spark, d)))


def both(spark, d):
    """Types and imports of one parse."""
    parsed = jv.parse(files(spark, d), keep=True)
    return jv.types(parsed), jv.imports(parsed)


def members(spark, d):
    types, _ = both(spark, d)
    return jv.methods(types).unionByName(jv.constructors(types))


def resolved(spark, d):
    types, _ = both(spark, d)
    return jv.resolve_names(jv.inheritance(types).where("type = 'EXTENDS'"), types)


def imported(spark, d):
    return jv.imports(jv.parse(files(spark, d)))


def resolved_as(kind):
    """Edges of a kind with full names: those from one class to one target are a row each."""

    def query(spark, d):
        types, _ = both(spark, d)
        edges = jv.inheritance(types).where("type = 'IMPLEMENTS'") if kind == "IMPLEMENTS" else jv.injections(types).withColumn("member", F.coalesce("member", F.lit("")))
        return jv.resolve_names(edges, types, kind != "INJECTS").select("path", "source", "target", "full_target", "target_module", *(["member"] if kind == "INJECTS" else []))

    return query


QUERIES = {
    "java_has_parameter": lambda spark, d: jv.parameter_edges(members(spark, d)).select("path", "type", "source", "target", "position"),
    "java_annotation_edges": lambda spark, d: jv.annotation_edges(*both(spark, d)).select("path", "type", F.regexp_replace("source", "@\\d+$", "").alias("source"), F.regexp_replace("target", "@\\d+$", "").alias("target"), "target_kind"),
    "java_implements_resolution": resolved_as("IMPLEMENTS"),
    "java_injects_resolution": resolved_as("INJECTS"),
    "java_types": lambda spark, d: found(spark, d).select("repository", "module", "path", "kind", "full_name", "visibility", "superclass"),
    "java_imports": lambda spark, d: imported(spark, d).select("path", "name", "simple_name", "wildcard"),
    "java_fields": lambda spark, d: jv.fields(found(spark, d)).select("path", "owner", "name", "type", "visibility", "static"),
    "java_methods": lambda spark, d: jv.methods(found(spark, d)).select("path", "owner", "name", "type", "visibility", "has_body"),
    "java_constructors": lambda spark, d: jv.constructors(found(spark, d)).select("path", "owner", F.size("parameters").alias("n_parameters")),
    "java_parameters": lambda spark, d: jv.parameters(members(spark, d)).select("path", "member", "name", "type", "position", "variadic"),
    "java_calls": lambda spark, d: jv.calls(jv.methods(found(spark, d))).select("path", "source", "target", "resolved", "constructor"),
    "java_inheritance": lambda spark, d: jv.inheritance(found(spark, d)).select("path", "source", "target", "type"),
    "java_injections": lambda spark, d: jv.injections(both(spark, d)[0]).select("path", "source", "target", "injection", "member"),
    "java_spring": lambda spark, d: jv.spring_components(found(spark, d)).select("path", "component", F.array_join("paths", "|").alias("paths"), F.array_join("http_methods", "|").alias("http_methods")),
    "java_annotations": lambda spark, d: jv.resolve_annotations(*both(spark, d)).select("path", "target_kind", "target", "full_name"),
    "java_annotation_attributes": lambda spark, d: rows(spark, d, "SELECT p_partkey, 'value = \"/a,' || p_brand || '\", method = {A, B}, n=' || CAST(p_size AS STRING) AS v FROM @part").select("p_partkey", F.array_join(F.transform(F.map_entries(jv.annotation_attributes(F.col("v"))), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("attributes")),
    "java_import_edges": lambda spark, d: jv.import_edges(*both(spark, d)),
    "java_name_resolution": lambda spark, d: resolved(spark, d).select("path", "full_target", "target_module"),
    "java_packages": lambda spark, d: jv.packages(found(spark, d)),
    "java_summary": lambda spark, d: jv.summary(files(spark, d), found(spark, d)),
}
D_CLASSES = f"SELECT *, {FULL} AS full_name FROM ({D}) WHERE shape < 3"
D_IMPORTS = f"SELECT path, 'org.spring.' || mark AS name, mark AS simple_name, false AS wildcard FROM ({D}) UNION ALL SELECT path, 'java.util', 'util', true FROM ({D})"
D_FIRST = "CASE WHEN package = '' THEN '' ELSE package || '.' END"
D_INDEX = f"SELECT *, {FULL} AS full_name FROM ({D})"


def d_resolved(edges: str, near: str) -> str:
    return f"""SELECT path, source, target, coalesce(full_name, target) AS full_target, module AS target_module, member FROM (SELECT e.path, e.source, e.target, e.member, t.full_name, t.module, row_number() OVER (PARTITION BY e.path, e.source, e.target, e.member ORDER BY {near} t.path) AS r
      FROM ({edges}) e LEFT JOIN ({D_INDEX}) t ON t.name = e.target) WHERE r = 1"""


D_HAS = f"SELECT path, target_kind, target, full_name, CASE WHEN full_name = 'Autowired' THEN 3 ELSE 2 END AS o FROM (SELECT path, 'type' AS target_kind, full_name AS target, 'org.spring.' || mark AS full_name FROM ({D_CLASSES}) UNION ALL SELECT path, 'type', full_name, 'GetMapping' FROM ({D_CLASSES}) WHERE mark = 'RestController' UNION ALL SELECT path, 'field', full_name || '#' || unnest(['dep', 'other']), 'Autowired' FROM ({D_CLASSES}))"
ORACLES = {
    "java_has_parameter": f"SELECT path, 'HAS_PARAMETER' AS type, full_name || '#' || m AS source, full_name || '#' || m || '(' || p || ')' AS target, CAST(o AS INTEGER) AS position FROM (SELECT path, full_name, 'run' AS m, unnest(['x', 'more']) AS p, unnest([0, 1]) AS o FROM ({D_CLASSES}) UNION ALL SELECT path, full_name, name, unnest(['a', 'n']), unnest([0, 1]) FROM ({D_CLASSES}) WHERE shape < 2)",
    "java_annotation_edges": f"SELECT path, 'HAS_ANNOTATION' AS type, target AS source, target || '@' || full_name AS target, target_kind FROM ({D_HAS})",
    "java_implements_resolution": "SELECT * EXCLUDE (member) FROM (" + d_resolved(f"SELECT path, package, name AS source, unnest(['Comparable', 'Api']) AS target, '' AS member FROM ({D}) WHERE shape < 3 UNION ALL SELECT path, package, name, unnest(['Base', 'Other']), '' FROM ({D}) WHERE shape = 3", "CASE WHEN t.package = e.package THEN 0 ELSE 1 END,") + ")",
    "java_injects_resolution": d_resolved(f"SELECT path, package, name AS source, used AS target, unnest(['dep', 'other']) AS member FROM ({D}) WHERE shape < 3 UNION ALL SELECT path, package, name, used, '' FROM ({D}) WHERE shape = 1", ""),
    "java_types": f"SELECT repository, module, path, CASE WHEN shape = 3 THEN 'interface' ELSE 'class' END AS kind, {FULL} AS full_name, CASE WHEN shape = 3 THEN 'package-private' ELSE 'public' END AS visibility, CASE shape WHEN 1 THEN used || '<String>' WHEN 3 THEN 'Base<' || used || '>' END AS superclass FROM ({D})",
    "java_imports": D_IMPORTS,
    "java_fields": f"SELECT path, full_name AS owner, n AS name, CASE n WHEN 'count' THEN 'int' ELSE used END AS type, CASE n WHEN 'count' THEN 'package-private' ELSE 'private' END AS visibility, n = 'count' AS static FROM (SELECT *, unnest(['dep', 'other', 'count']) AS n FROM ({D_CLASSES}))",
    "java_methods": f"SELECT path, full_name AS owner, n AS name, CASE n WHEN 'run' THEN 'List<String>' ELSE 'void' END AS type, CASE n WHEN 'run' THEN 'public' ELSE 'package-private' END AS visibility, n = 'run' AS has_body FROM (SELECT *, unnest(['run', 'none']) AS n FROM ({D_CLASSES})) UNION ALL SELECT path, {FULL}, 'one', 'int', 'package-private', false FROM ({D}) WHERE shape = 3",
    "java_constructors": f"SELECT path, full_name AS owner, 2 AS n_parameters FROM ({D_CLASSES}) WHERE shape < 2 UNION ALL SELECT path, full_name, 0 FROM ({D_CLASSES}) WHERE shape = 0",
    "java_parameters": f"SELECT path, 'run' AS member, 'x' AS name, 'int' AS type, 0 AS position, false AS variadic FROM ({D_CLASSES}) UNION ALL SELECT path, 'run', 'more', 'Map<String, Integer>', 1, true FROM ({D_CLASSES}) UNION ALL SELECT path, name, 'a', used, 0, false FROM ({D_CLASSES}) WHERE shape < 2 UNION ALL SELECT path, name, 'n', 'int', 1, false FROM ({D_CLASSES}) WHERE shape < 2",
    "java_calls": f"SELECT path, full_name || '#run' AS source, CASE t WHEN 'helper' THEN full_name || '#helper' WHEN 'go' THEN 'dep.go' WHEN 'of' THEN {D_FIRST} || 'Util#of' ELSE {D_FIRST} || 'Made#<init>' END AS target, t <> 'go' AS resolved, t = 'made' AS constructor FROM (SELECT *, unnest(['helper', 'go', 'of', 'made']) AS t FROM ({D_CLASSES}))",
    "java_inheritance": f"SELECT path, name AS source, used AS target, 'EXTENDS' AS type FROM ({D}) WHERE shape = 1 UNION ALL SELECT path, name, unnest(['Comparable', 'Api']), 'IMPLEMENTS' FROM ({D}) WHERE shape < 3 UNION ALL SELECT path, name, unnest(['Base', 'Other']), 'IMPLEMENTS' FROM ({D}) WHERE shape = 3",
    "java_injections": f"SELECT path, name AS source, used AS target, 'field' AS injection, unnest(['dep', 'other']) AS member FROM ({D}) WHERE shape < 3 UNION ALL SELECT path, name, used, 'constructor', NULL FROM ({D}) WHERE shape = 1",
    "java_spring": f"SELECT path, CASE mark WHEN 'Service' THEN 'service' ELSE 'controller' END AS component, CASE mark WHEN 'Service' THEN '' ELSE '/p' || k END AS paths, CASE mark WHEN 'Service' THEN '' ELSE 'GET' END AS http_methods FROM ({D}) WHERE shape < 3 AND mark <> 'Helper'",
    "java_annotations": f"SELECT path, 'type' AS target_kind, full_name AS target, 'org.spring.' || mark AS full_name FROM ({D_CLASSES}) UNION ALL SELECT path, 'type', full_name, 'GetMapping' FROM ({D_CLASSES}) WHERE mark = 'RestController' UNION ALL SELECT path, 'field', full_name || '#' || unnest(['dep', 'other']), 'Autowired' FROM ({D_CLASSES})",
    "java_annotation_attributes": "SELECT p_partkey, 'value=/a,' || p_brand || ';method={A, B};n=' || p_size AS attributes FROM part",
    "java_import_edges": f"SELECT {FULL} AS source, i.name AS target FROM ({D}) f JOIN ({D_IMPORTS}) i USING (path)".replace("THEN name ELSE package || '.' || name END AS source", "THEN f.name ELSE package || '.' || f.name END AS source"),
    "java_name_resolution": f"""SELECT path, coalesce(full_name, used) AS full_target, module AS target_module FROM (SELECT e.path, e.used, t.full_name, t.module, row_number() OVER (PARTITION BY e.path ORDER BY CASE WHEN t.package = e.package THEN 0 ELSE 1 END, t.path) AS r
      FROM ({D}) e LEFT JOIN (SELECT *, {FULL} AS full_name FROM ({D})) t ON t.name = e.used WHERE e.shape = 1) WHERE r = 1""",
    "java_packages": f"SELECT package, count(*) AS n_types, count(DISTINCT path) AS n_files FROM ({D}) GROUP BY package",
    "java_summary": f"SELECT repository, module, count(*) AS files, count(*) FILTER (shape < 3) AS classes, count(*) FILTER (shape = 3) AS interfaces, 0::BIGINT AS enums, CAST(sum(CASE WHEN shape < 3 THEN 2 ELSE 1 END) AS BIGINT) AS methods, CAST(sum(CASE WHEN shape < 3 THEN 3 ELSE 0 END) AS BIGINT) AS fields, CAST(sum(CASE shape WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END) AS BIGINT) AS constructors FROM ({D}) GROUP BY ROLLUP (repository, module)",
}
