"""Versions and other facts that names, paths and the first lines of texts give away."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import tables
from graphloom.functions.names import first_non_blank


def content_version(text: Column, rules=tables.CONTENT_VERSIONS) -> Column:
    """``version`` (with a v in front) and ``rule`` of the first rule that finds one."""
    found = lambda p: F.nullif(F.regexp_extract(text, f"(?U){p}", 1), F.lit(""))
    return F.coalesce(*[F.when(found(p).isNotNull(), F.struct(F.concat(F.lit("v"), found(p)).alias("version"), F.lit(name).alias("rule"))) for name, p in rules])


def path_version(text: Column) -> Column:
    """From the first pattern that a path holds: its numbers, joined by dots."""
    out = []
    for pattern, groups in tables.PATH_VERSIONS:
        numbers = [F.nullif(F.regexp_extract(text, f"(?U){pattern}", k), F.lit("")) for k in range(1, groups + 1)]
        out.append(F.when(numbers[0].isNotNull(), F.concat(F.lit("v"), F.concat_ws(".", *numbers))))
    return F.coalesce(*out)


def version_with_source(given: Column, paths: list[Column], content: Column) -> Column:
    """Stated, else of the first path that has one, else of the content; with where it comes from."""
    stated = F.nullif(F.regexp_replace(F.trim(given), "^[vV]+", ""), F.lit(""))
    pair = lambda v, s: F.when(v.isNotNull(), F.struct(v.alias("version"), s.alias("source")))
    return F.coalesce(
        pair(F.concat(F.lit("v"), stated), F.lit("metadata")), *[pair(path_version(p), F.lit("source_path")) for p in paths],
        pair(content["version"], F.concat(F.lit("content:"), content["rule"])),
    )


def file_stem(stem: Column) -> Column:
    """A file's name without the endings that say nothing, each taken off once, in order."""
    for s in tables.FILE_SUFFIXES:
        stem = F.regexp_replace(stem, f"(?i){s}$", "")
    return stem


def file_version(stem: Column) -> Column:
    found = F.coalesce(*[F.nullif(F.regexp_extract(stem, p, 1), F.lit("")) for p in tables.FILE_VERSIONS])
    return F.translate(found, "_", ".")


def specification_name(stem: Column) -> Column:
    """Words of a file's name with capitals, acronyms all in capitals."""
    bare = F.when(file_version(stem).isNull(), stem).otherwise(F.regexp_replace(stem, tables.FILE_VERSION_PART, ""))
    words = F.filter(F.split(F.translate(bare, "_", " "), r"\s+"), lambda w: w != "")
    return F.nullif(F.array_join(F.transform(words, lambda w: F.when(F.lower(w).isin(*tables.FILE_ACRONYMS), F.upper(w)).otherwise(F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.lower(F.substr(w, F.lit(2)))))), " "), F.lit(""))


def file_category(stem: Column) -> Column:
    return F.coalesce(*[F.when(F.lower(stem).contains(word), label) for word, label in tables.FILE_CATEGORIES])


def _head(text: Column, lines: int) -> Column:
    return F.array_join(F.slice(F.split(text, "\r\n|[\n\r]"), 1, lines), "\n")


def content_title(text: Column) -> Column:
    """The first level-1 heading of the head, without link targets."""
    found = F.regexp_extract(_head(text, tables.TITLE_LINES), tables.HEAD_TITLE, 1)
    return F.nullif(F.regexp_replace(found, tables.TITLE_LINK, "$1"), F.lit(""))


def content_spec_version(text: Column) -> Column:
    head = _head(text, tables.VERSION_LINES)
    return F.coalesce(*[F.nullif(F.regexp_extract(head, p, 1), F.lit("")) for p in tables.HEAD_VERSIONS])


def content_organisation(text: Column) -> Column:
    head = _head(text, tables.HEAD_LINES)
    by = F.nullif(F.regexp_extract(head, tables.HEAD_AUTHOR, 1), F.lit(""))
    return F.coalesce(*[F.when(head.contains(o), o) for o in tables.ORGANISATIONS], by)


def content_date(text: Column) -> Column:
    head = _head(text, tables.HEAD_LINES)
    return F.coalesce(*[F.nullif(F.regexp_extract(head, p, 1), F.lit("")) for p in tables.HEAD_DATES])


def specification_metadata(frontmatter: Column, stem: Column, text: Column) -> dict[str, Column]:
    """Each field from the frontmatter, else the file's name, else the text, else ``unknown``."""
    at = lambda *keys: [F.try_element_at(frontmatter, F.lit(k)) for k in keys]
    bare = file_stem(stem)
    return {
        "name": first_non_blank(*at("specification_name", "title", "name"), specification_name(bare), content_title(text), F.lit("unknown")),
        "version": first_non_blank(*at("specification_version", "version"), file_version(bare), content_spec_version(text), F.lit("unknown")),
        "category": first_non_blank(*at("specification_category", "category"), file_category(bare), F.lit("unknown")),
        "organisation": first_non_blank(*at("organization", "author", "publisher"), content_organisation(text), F.lit("unknown")),
        "published": first_non_blank(*at("publication_date", "date", "published"), content_date(text), F.lit("unknown")),
    }


def link_version(title: Column, trailing: bool = False) -> Column:
    pattern = tables.TRAILING_VERSION if trailing else tables.LINK_VERSION
    return F.coalesce(F.nullif(F.regexp_extract(title, pattern, 1), F.lit("")), F.lit("unknown"))


def path_parts_version(path: Column) -> Column:
    """A version in the deepest part of a path that has one, else empty."""
    parts = F.transform(F.reverse(F.split(path, "/")), lambda p: F.regexp_extract(p, tables.PART_VERSION, 1))
    return F.coalesce(F.get(F.filter(parts, lambda v: v != ""), F.lit(0)), F.lit(""))
