"""Repositories as rows: file inventory, build systems, modules, and configuration files."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.names import strip

# Directories whose files don't count, source roots, and what build files are called.
EXCLUDED = (".git", "target", "build", ".gradle", "node_modules", ".mvn", ".idea")
SOURCE_ROOTS = ("src/main/java", "src/test/java", "src/main/groovy", "src/test/groovy", "src")
KINDS = {".properties": "properties", ".yml": "yaml", ".yaml": "yaml", ".xml": "xml"}
MAVEN, GRADLE = ("pom.xml",), ("build.gradle", "build.gradle.kts", "settings.gradle", "settings.gradle.kts")
#: Bytes of a source file that its package is looked for in.
PACKAGE_HEAD = 4096


def inventory(files: DataFrame) -> DataFrame:
    """Java files with package, number of lines and source root: a usual one, else what the package leaves of the path."""
    package = F.nullif(F.regexp_extract(F.substr("text", F.lit(1), F.lit(PACKAGE_HEAD)), r"(?m)^\s*package\s+([\w.]+)\s*;", 1), F.lit(""))
    lines = F.when(F.length("text") == 0, 0).otherwise(F.size(F.split("text", "\n", -1)) - F.col("text").endswith("\n").cast("int"))
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    known = F.coalesce(*[F.when(F.col("path").startswith(f"{r}/"), r) for r in SOURCE_ROOTS])
    under = F.when(F.concat(F.lit("/"), folder).endswith(F.concat(F.lit("/"), F.translate("package", ".", "/"))), strip(F.regexp_replace(F.substr(folder, F.lit(1), F.greatest(F.length(folder) - F.length("package"), F.lit(0))), "/$", "")))
    return files.where(F.col("path").endswith(".java")).withColumn("package", package).select("repository", "path", "package", lines.alias("n_lines"), F.coalesce(known, under, F.lit("")).alias("source_root"))


def build_systems(files: DataFrame) -> DataFrame:
    """One row a directory with build files; a POM beats Gradle."""
    parts = files.select("repository", F.regexp_replace("path", "/?[^/]*$", "").alias("directory"), F.element_at(F.split("path", "/"), -1).alias("file"))
    out = parts.groupBy("repository", "directory").agg(F.bool_or(F.col("file").isin(*MAVEN)).alias("maven"), F.bool_or(F.col("file").isin(*GRADLE)).alias("gradle"))
    return out.select("repository", "directory", F.when(F.col("maven"), "maven").when(F.col("gradle"), "gradle").otherwise("unknown").alias("build_system"))


@F.pandas_udf(T.StringType())
def _xml_facts(texts: pd.Series) -> pd.Series:
    """What POMs and other XML files say, as JSON; null for what isn't well-formed. Namespaces don't count."""
    from xml.etree import ElementTree

    def one(text):
        try:
            root = ElementTree.fromstring(text.strip())
        except (ElementTree.ParseError, AttributeError, ValueError):
            return None
        for e in root.iter():
            e.tag = e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""
        get = lambda path: (root.findtext(path) or "").strip() or None
        several = lambda path: [(e.text or "").strip() for e in root.findall(path) if (e.text or "").strip()]
        known = root.find("properties")
        return json.dumps({
            "root": root.tag, "children": sorted({e.tag for e in root}), "change_sets": [e.get("id") for e in root.findall("changeSet")], "beans": [e.get("id") for e in root.findall("bean")],
            "group_id": get("groupId") or get("parent/groupId"), "artifact_id": get("artifactId"), "version": get("version") or get("parent/version"), "packaging": get("packaging") or "jar", "parent": get("parent/artifactId"),
            "modules": several("modules/module"), "dependencies": several("dependencies/dependency/artifactId"), "plugins": several("build/plugins/plugin/artifactId"),
            "properties": {e.tag: (e.text or "").strip() for e in known} if known is not None else {},
        })

    return texts.map(one)


_FACTS = """struct<root:string,children:array<string>,change_sets:array<string>,beans:array<string>,group_id:string,artifact_id:string,version:string,packaging:string,parent:string,
  modules:array<string>,dependencies:array<string>,plugins:array<string>,properties:map<string,string>>"""


def _dealt(files: DataFrame) -> DataFrame:
    """Files dealt to all cores: parsing is what costs, and a scan may have few splits."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "repository", "path")


def _xml(files: DataFrame) -> DataFrame:
    """Well-formed XML files with ``x``; others are passed over."""
    return _dealt(files).withColumn("x", F.from_json(_xml_facts.asNondeterministic()("text"), _FACTS)).where("x IS NOT NULL")


def maven(files: DataFrame) -> DataFrame:
    """POM coordinates (group and version from the parent where the project has none), modules, dependencies, plugins,
    properties."""
    return _xml(files.where(F.col("path").rlike("(^|/)pom\\.xml$"))).select("repository", "path", "x.group_id", "x.artifact_id", "x.version", "x.packaging", "x.modules", "x.dependencies", "x.plugins", "x.properties")


def gradle(files: DataFrame) -> DataFrame:
    one = lambda k: F.nullif(F.regexp_extract("text", rf"(?m)^\s*{k}\s*=?\s*['\"]([^'\"]+)['\"]", 1), F.lit(""))
    found = F.regexp_extract_all("text", F.lit(r"(?:implementation|api|compile|testImplementation|runtimeOnly)\s*\(?\s*['\"]([^'\"]+)['\"]"), F.lit(1))
    included = F.regexp_extract_all("text", F.lit(r"include\s*\(?\s*['\"]:?([^'\"]+)['\"]"), F.lit(1))
    return files.where(F.col("path").rlike(r"(^|/)(build|settings)\.gradle(\.kts)?$")).select("repository", "path", one("group").alias("group_id"), one("version").alias("version"), found.alias("dependencies"), included.alias("modules"))


def modules(declared: DataFrame, files: DataFrame) -> DataFrame:
    """Declared modules whose directories exist; a repository without any is its own module."""
    folders = files.select("repository", F.regexp_replace("path", "/?[^/]*$", "").alias("folder")).distinct()
    parts = folders.select("repository", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("folder", "/"))), lambda k: F.array_join(F.slice(F.split("folder", "/"), 1, k), "/"))).alias("module")).where("module <> ''").distinct()
    found = declared.select("repository", F.explode("modules").alias("module")).distinct().join(parts, ["repository", "module"], "left_semi")
    return files.select("repository").distinct().join(found, "repository", "left").select("repository", F.coalesce("module", F.lit("")).alias("module"))


def resources(files: DataFrame, declared: DataFrame) -> DataFrame:
    """Configuration files outside excluded directories, with the deepest module that holds them, else ``root``."""
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    kind = F.coalesce(*[F.when(suffix == s, k) for s, k in KINDS.items()])
    used = files.withColumn("kind", kind).where("kind IS NOT NULL").where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, EXCLUDED))))
    # every folder above a file is a key, so the prefix join is an equality
    above = F.filter(F.transform(F.sequence(F.lit(1), F.size(F.split("path", "/"))), lambda k: F.array_join(F.slice(F.split("path", "/"), 1, k), "/")), lambda p: p != F.col("path"))
    near = used.select("repository", "path", F.explode(above).alias("module")).join(declared.where("module <> ''"), ["repository", "module"]).groupBy("repository", "path").agg(F.max_by("module", F.length("module")).alias("module"))
    return used.join(near, ["repository", "path"], "left").select("repository", "path", "kind", F.coalesce("module", F.lit("root")).alias("module"))


def properties(files: DataFrame) -> DataFrame:
    """``key``, ``value`` of .properties texts: lines that end in a backslash go on, ``=`` is tried before ``:``, the last
    of equal keys wins."""
    text = F.regexp_replace("text", r"\\\r?\n[ \t]*", "")
    rows = files.select("repository", "path", F.posexplode(F.split(text, r"\r?\n")).alias("line", "raw")).withColumn("raw", strip(F.col("raw"))).where((F.col("raw") != "") & ~F.col("raw").rlike("^[#!]"))
    key = F.coalesce(F.when(F.col("raw").contains("="), F.substring_index("raw", "=", 1)), F.when(F.col("raw").contains(":"), F.substring_index("raw", ":", 1)), F.col("raw"))
    value = F.when(F.col("raw").contains("=") | F.col("raw").contains(":"), F.substr("raw", F.length(key) + 2)).otherwise("")
    return rows.groupBy("repository", "path", strip(key).alias("key")).agg(F.max_by(strip(value), "line").alias("value"))


def flatten(data, prefix: str = "") -> dict:
    """Dotted paths of a tree's leaves; list items go by number."""
    items = data.items() if isinstance(data, dict) else enumerate(data)
    out = {}
    for k, v in items:
        at = f"{prefix}.{k}" if prefix else str(k)
        if isinstance(v, (dict, list)) and v:
            out |= flatten(v, at)
        else:
            out[at] = v
    return out


@F.pandas_udf(T.StringType())
def _flat_yaml(texts: pd.Series) -> pd.Series:
    import yaml

    class Loader(yaml.SafeLoader):
        """Takes unknown tags for their plain values."""

    def plain(loader, suffix, node):
        if isinstance(node, yaml.MappingNode):
            return loader.construct_mapping(node, deep=True)
        return loader.construct_sequence(node, deep=True) if isinstance(node, yaml.SequenceNode) else loader.construct_scalar(node)

    Loader.add_multi_constructor("", plain)

    def one(text):
        if text is None or "{{" in text:
            return None
        try:
            merged: dict = {}
            for part in yaml.load_all(text, Loader):
                if isinstance(part, dict):
                    merged |= part
        except yaml.YAMLError:
            return None
        return json.dumps({k: None if v is None else v if isinstance(v, str) else json.dumps(v, default=str) for k, v in flatten(merged).items()})

    return texts.map(one)


def yaml_entries(files: DataFrame) -> DataFrame:
    """Leaves of YAML texts; documents of a text are merged at the top, templates and broken texts are passed over."""
    return _dealt(files).select("repository", "path", F.explode(F.from_json(_flat_yaml.asNondeterministic()("text"), "map<string,string>")).alias("key", "value"))


def xml_files(files: DataFrame) -> DataFrame:
    """What an XML file is, by its root element, its distinct child elements, and what it declares."""
    kind = F.when(F.col("x.root") == "project", "pom").when(F.col("x.root") == "databaseChangeLog", "liquibase").when(F.col("x.root") == "beans", "spring").otherwise("generic")
    return _xml(files).select("repository", "path", kind.alias("kind"), "x.root", "x.change_sets", "x.beans", "x.children")


def resource_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("repository").agg(F.count("*").alias("n"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("properties", "yaml", "xml")], F.countDistinct("module").alias("n_modules"))
