"""Java sources as rows: types, members, calls, and the edges between them.

Files are ``repository``, ``module``, ``path`` and ``text``. Each is parsed once, by an Arrow function, into JSON; all
that follows is columns.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions import java
from graphloom.functions.checkpoints import checkpoint
from graphloom.functions.names import lookup

# Annotations that decide what a Spring component is, by priority, and what HTTP methods they stand for.
CONTROLLER = ("RestController", "Controller", "RequestMapping", "GetMapping", "PostMapping", "PutMapping", "DeleteMapping", "PatchMapping")
COMPONENTS = ((CONTROLLER, "controller"), (("Service",), "service"), (("Repository",), "repository"), (("Entity",), "entity"), (("Component",), "component"))
HTTP_METHODS = {"GetMapping": "GET", "PostMapping": "POST", "PutMapping": "PUT", "DeleteMapping": "DELETE", "PatchMapping": "PATCH"}
INJECTING = ("Autowired", "Inject", "Resource")
PRIMITIVES = ("int", "long", "double", "float", "boolean", "char", "byte", "short", "void")
VISIBILITIES = ("public", "protected", "private")

_ANNOTATION = "struct<name:string,value:string,line:int>"
_PARAMETER = f"struct<name:string,type:string,position:int,variadic:boolean,final:boolean,annotations:array<{_ANNOTATION}>>"
_CALL = "struct<target_class:string,target_method:string,line:int,constructor:boolean>"
_MEMBER = f"name:string,modifiers:array<string>,annotations:array<{_ANNOTATION}>,line:int"
SHAPE = f"""struct<package:string,imports:array<struct<name:string,static:boolean,wildcard:boolean,line:int>>,types:array<struct<{_MEMBER},kind:string,`end`:int,`extends`:array<string>,implements:array<string>,
  fields:array<struct<{_MEMBER},type:string>>,methods:array<struct<{_MEMBER},type:string,`end`:int,has_body:boolean,parameters:array<{_PARAMETER}>,calls:array<{_CALL}>>>,
  constructors:array<struct<{_MEMBER},`end`:int,parameters:array<{_PARAMETER}>,calls:array<{_CALL}>>>>>>"""
_FILE = ["repository", "module", "path", "package"]


@F.pandas_udf(T.StringType())
def _read(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: json.dumps(java.read(t)))


_read_once = _read.asNondeterministic()  # else what is filtered by a tree's parts would be parsed below the filter, and again above


def parse(files: DataFrame, keep: bool = False) -> DataFrame:
    """Files with their parse tree. Parsing is what costs here, so files are dealt to all cores first; with ``keep`` the
    trees are written to the shared checkpoint folder, for plans that read them more than once."""
    width = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = files.repartition(width, "repository", "path").withColumn("j", _read_once("text")).drop("text")
    made = checkpoint(made) if keep else made
    return made.withColumn("j", F.from_json("j", SHAPE)).withColumn("package", F.col("j.package"))


def visibility(modifiers: Column) -> Column:
    """The first of the access modifiers as written, package-private if there is none."""
    return F.coalesce(F.get(F.filter(modifiers, lambda m: m.isin(*VISIBILITIES)), F.lit(0)), F.lit("package-private"))


def qualified(package: Column, name: Column) -> Column:
    return F.when(package == "", name).otherwise(F.concat_ws(".", package, name))


def types(parsed: DataFrame) -> DataFrame:
    t = parsed.select(*_FILE, F.explode("j.types").alias("t"))
    return t.select(*_FILE, "t.kind", "t.name", qualified(F.col("package"), F.col("t.name")).alias("full_name"), "t.line", "t.end", visibility(F.col("t.modifiers")).alias("visibility"), F.get("t.extends", F.lit(0)).alias("superclass"), "t.extends", "t.implements", "t.annotations", "t.fields", "t.methods", "t.constructors")


def imports(parsed: DataFrame) -> DataFrame:
    i = parsed.select(*_FILE, F.explode("j.imports").alias("i"))
    return i.select(*_FILE, "i.name", F.element_at(F.split("i.name", r"\."), -1).alias("simple_name"), "i.static", "i.wildcard", "i.line")


def _of(found: DataFrame) -> list:
    return [*_FILE, F.col("full_name").alias("owner"), F.col("name").alias("class")]


def fields(found: DataFrame) -> DataFrame:
    f = found.select(*_of(found), F.explode("fields").alias("f"))
    has = lambda m: F.array_contains("f.modifiers", m)
    return f.select(*_FILE, "owner", "class", "f.name", "f.type", "f.line", visibility(F.col("f.modifiers")).alias("visibility"), has("static").alias("static"), has("final").alias("final"), "f.annotations")


def methods(found: DataFrame) -> DataFrame:
    """Methods; one has a body unless it is abstract, or an interface's that stands on one line."""
    m = found.select(*_of(found), "kind", F.explode("methods").alias("m"))
    bare = (F.col("kind") == "interface") | F.array_contains("m.modifiers", "abstract")
    return m.select(*_FILE, "owner", "class", "m.name", "m.type", "m.line", "m.end", visibility(F.col("m.modifiers")).alias("visibility"), (~bare | (F.col("m.line") != F.col("m.end"))).alias("has_body"), "m.annotations", "m.parameters", "m.calls")


def constructors(found: DataFrame) -> DataFrame:
    c = found.select(*_of(found), F.explode("constructors").alias("c"))
    return c.select(*_FILE, "owner", "class", "c.name", F.lit(None).cast("string").alias("type"), "c.line", "c.end", visibility(F.col("c.modifiers")).alias("visibility"), F.lit(True).alias("has_body"), "c.annotations", "c.parameters", "c.calls")


def parameters(members: DataFrame) -> DataFrame:
    """Parameters with the member that has them, which is the edge from one to the other."""
    p = members.select("path", "owner", F.col("name").alias("member"), "line", F.explode("parameters").alias("p"))
    return p.select("path", "owner", "member", "line", "p.name", "p.type", "p.position", "p.variadic")


def calls(members: DataFrame) -> DataFrame:
    """Calls once for each member and target, with the place of the first, and the target as far as it can be told.

    Without a receiver it is the own class; a receiver with a dot is taken as it is; one that begins with a capital, or
    is the own class, is of the same package; any other is a variable, and stays unresolved.
    """
    c = members.select("path", "package", "class", F.col("name").alias("source_method"), F.posexplode("calls").alias("nth", "c"))
    to, method = F.col("c.target_class"), F.col("c.target_method")
    target = F.when(to.isNull(), method).otherwise(F.concat_ws(".", to, method))
    first = c.withColumn("target", target).groupBy("path", "package", "class", "source_method", "target").agg(F.min(F.struct("nth", "c")).alias("f"))
    to, method = F.col("f.c.target_class"), F.col("f.c.target_method")
    near = F.concat_ws("#", qualified(F.col("package"), F.coalesce(to, F.col("class"))), method)
    resolved = to.isNull() | to.contains(".") | to.rlike(r"^\p{Lu}") | (to == F.col("class"))
    name = F.when(to.isNotNull() & to.contains("."), F.concat_ws("#", to, method)).when(resolved, near).otherwise(F.col("target"))
    source = F.concat_ws("#", qualified(F.col("package"), F.col("class")), "source_method")
    return first.select("path", source.alias("source"), name.alias("target"), resolved.alias("resolved"), F.col("f.c.line").alias("line"), F.col("f.c.constructor").alias("constructor"))


def base_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "<.*$", ""))


def inheritance(found: DataFrame) -> DataFrame:
    """EXTENDS for a class's superclass, IMPLEMENTS for all interfaces; an interface's bases count as implemented."""
    up = found.where("kind = 'class'").select("path", "package", F.col("name").alias("source"), F.explode("extends").alias("target"), F.lit("EXTENDS").alias("type"))
    more = found.select("path", "package", F.col("name").alias("source"), F.explode(F.when(F.col("kind") == "interface", F.col("extends")).otherwise(F.col("implements"))).alias("target"), F.lit("IMPLEMENTS").alias("type"))
    return up.union(more).withColumn("target", base_name(F.col("target")))


def injections(found: DataFrame) -> DataFrame:
    """What fields, constructors and setters get injected: annotated ones, and the only constructor of a class. Each type is
    read once for all."""
    marked = lambda m: F.exists(m["annotations"], lambda x: x["name"].isin(*INJECTING))
    row = lambda t, kind, member: F.struct(t.alias("target"), F.lit(kind).alias("injection"), member.alias("member"))
    given = lambda m, kind, member: F.transform(m["parameters"], lambda p: row(p["type"], kind, member))
    f = F.transform(F.filter("fields", marked), lambda m: row(m["type"], "field", m["name"]))
    c = F.flatten(F.transform(F.filter("constructors", lambda m: (F.size("constructors") == 1) | marked(m)), lambda m: given(m, "constructor", F.lit(None).cast("string"))))
    s = F.flatten(F.transform(F.filter("methods", marked), lambda m: given(m, "setter", m["name"])))
    found = found.select("path", "package", F.col("name").alias("source"), F.inline(F.concat(*[F.coalesce(x, F.array()) for x in (f, c, s)])))
    return found.withColumn("target", base_name(F.col("target"))).where(~F.col("target").isin(*PRIMITIVES) & (F.col("target") != ""))


def spring_components(found: DataFrame) -> DataFrame:
    """Types with a stereotype: the component by priority, paths and HTTP methods of the type's annotations."""
    listed = F.transform("annotations", lambda a: a["name"])
    kind = F.coalesce(*[F.when(F.arrays_overlap(listed, F.array(*map(F.lit, group))), label) for group, label in COMPONENTS])
    texts = F.transform(F.filter("annotations", lambda a: a["name"].endswith("Mapping")), lambda a: F.regexp_extract_all(F.regexp_replace(F.coalesce(a["value"], F.lit("")), r'(?:produces|consumes|headers|params|name)\s*=\s*(?:\{[^}]*\}|"[^"]*")', ""), F.lit('"([^"]*)"'), F.lit(1)))
    verbs = F.array_distinct(F.filter(F.concat(F.transform("annotations", lambda a: lookup(a["name"], HTTP_METHODS)), F.flatten(F.transform("annotations", lambda a: F.regexp_extract_all(F.coalesce(a["value"], F.lit("")), F.lit(r"RequestMethod\.(\w+)"), F.lit(1))))), lambda v: v.isNotNull()))
    return found.withColumn("component", kind).where("component IS NOT NULL").select("path", "full_name", "component", F.array_distinct(F.flatten(texts)).alias("paths"), verbs.alias("http_methods"))


def annotations(found: DataFrame) -> DataFrame:
    """All annotations with what they stand on; each type is read once for all."""
    def on(kind: str, target: Column, listed: Column) -> Column:
        return F.transform(listed, lambda a: F.struct(F.lit(kind).alias("target_kind"), target.alias("target"), a["name"].alias("name"), a["value"].alias("value"), a["line"].alias("line")))

    member = lambda kind: lambda m: on(kind, F.concat_ws("#", "full_name", m["name"]), m["annotations"])
    parameter = lambda m: F.flatten(F.transform(m["parameters"], lambda p: on("parameter", F.concat(F.col("full_name"), F.lit("#"), m["name"], F.lit("("), p["name"], F.lit(")")), p["annotations"])))
    parts = [on("type", F.col("full_name"), F.col("annotations")), *[F.flatten(F.transform(of, member(kind))) for of, kind in (("fields", "field"), ("methods", "method"), ("constructors", "constructor"))], F.flatten(F.transform("methods", parameter))]
    return found.select("path", F.inline(F.concat(*[F.coalesce(p, F.array()) for p in parts])))


def annotation_attributes(value: Column) -> Column:
    """``k = v, ...`` as a map; a value alone is ``value``. Commas inside quotes and brackets part nothing."""
    parts = F.filter(F.transform(F.split(value, r',(?=(?:[^"]*"[^"]*")*[^"]*$)(?![^({\[]*[)}\]])'), lambda p: F.trim(p)), lambda p: p != "")
    clean = lambda v: F.regexp_replace(F.trim(v), '^"|"$', "")
    pair = lambda p: F.when(p.rlike(r"^\w+\s*="), F.struct(F.regexp_extract(p, r"^(\w+)", 1).alias("k"), clean(F.regexp_replace(p, r"^\w+\s*=", "")).alias("v"))).otherwise(F.struct(F.lit("value").alias("k"), clean(p).alias("v")))
    return F.map_from_entries(F.transform(parts, pair))


def resolve_annotations(found: DataFrame, imported: DataFrame) -> DataFrame:
    """Annotations with the full name that the file's imports give them; the last import of a name wins."""
    index = imported.where("NOT wildcard").groupBy("path", F.col("simple_name").alias("name")).agg(F.max_by("name", "line").alias("imported"))
    return annotations(found).join(index.hint("shuffle_hash"), ["path", "name"], "left").withColumn("full_name", F.coalesce("imported", "name")).drop("imported")


def annotation_edges(found: DataFrame, imported: DataFrame) -> DataFrame:
    """HAS_ANNOTATION from what is annotated, and ANNOTATION_TYPE from an annotation to its declared type. An annotation is
    named by its path, what it stands on, its full name and line."""
    declared = found.select("full_name").distinct().withColumn("declared", F.lit(True)).hint("shuffle_hash")
    a = resolve_annotations(found, imported).join(declared, "full_name", "left")
    node = F.concat_ws("@", "target", "full_name", F.col("line").cast("string"))
    edge = lambda kind, source, target: F.struct(F.lit(kind).alias("type"), source.alias("source"), target.alias("target"), F.col("target_kind"))
    has, of = edge("HAS_ANNOTATION", F.col("target"), node), edge("ANNOTATION_TYPE", node, F.col("full_name"))
    return a.select("path", F.inline(F.when(F.col("declared"), F.array(has, of)).otherwise(F.array(has))))


def parameter_edges(members: DataFrame) -> DataFrame:
    """HAS_PARAMETER from a method or constructor to each of its parameters."""
    p = parameters(members)
    source = F.concat_ws("#", "owner", "member")
    return p.select("path", F.lit("HAS_PARAMETER").alias("type"), source.alias("source"), F.concat(source, F.lit("("), F.col("name"), F.lit(")")).alias("target"), "line", "position")


def annotation_types(found: DataFrame, imported: DataFrame) -> DataFrame:
    """Annotations whose full name is a declared type."""
    return resolve_annotations(found, imported).join(found.select("full_name").distinct(), "full_name", "left_semi")


def import_edges(found: DataFrame, imported: DataFrame) -> DataFrame:
    return found.select("path", F.col("full_name").alias("source")).join(imported.select("path", F.col("name").alias("target")), "path").select("source", "target")


def resolve_names(edges: DataFrame, found: DataFrame, same_package: bool = True) -> DataFrame:
    """Simple target names as full names of declared types: of the same package if there is one, else the first by path.

    The first type of each name (and package) is found before edges look it up, so an edge meets two rows at most, however
    many types share a name; these are written to the shared checkpoint folder, as both lookups read them.
    """
    index = checkpoint(found.groupBy(F.col("name").alias("target"), "package").agg(F.min(F.struct("path", "full_name", "module")).alias("near")))
    any_ = index.groupBy("target").agg(F.min("near").alias("any"))
    out = edges.where(~F.col("target").contains(".")).distinct().join(any_.hint("shuffle_hash"), "target", "left")
    out = out.join(index.hint("shuffle_hash"), ["target", "package"], "left") if same_package else out.withColumn("near", F.col("any"))
    best = F.coalesce("near", "any")
    plain = out.select(*edges.columns, F.coalesce(best["full_name"], F.col("target")).alias("full_target"), best["module"].alias("target_module"))
    return plain.union(edges.where(F.col("target").contains(".")).select(*edges.columns, F.col("target"), F.lit(None).cast("string")))


def packages(found: DataFrame) -> DataFrame:
    """Packages with the number of their types: what BELONGS_TO points to."""
    return found.groupBy("package").agg(F.count("*").alias("n_types"), F.countDistinct("path").alias("n_files"))


def summary(files: DataFrame, found: DataFrame) -> DataFrame:
    """Counters by repository and module, with totals where the module, or both, are null."""
    per = found.select("repository", "module", "path", F.size("methods").alias("m"), F.size("fields").alias("f"), F.size("constructors").alias("c"), "kind")
    return per.rollup("repository", "module").agg(
        F.countDistinct("path").alias("files"), F.count_if(F.col("kind") == "class").alias("classes"), F.count_if(F.col("kind") == "interface").alias("interfaces"), F.count_if(F.col("kind") == "enum").alias("enums"),
        F.sum("m").alias("methods"), F.sum("f").alias("fields"), F.sum("c").alias("constructors"),
    )
