"""Predicates and parts of link targets."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import tables


def is_external(url: Column) -> Column:
    return F.coalesce(functools.reduce(lambda a, b: a | b, [url.startswith(s) for s in tables.EXTERNAL_SCHEMES]), F.lit(False))


def is_anchor(url: Column) -> Column:
    return F.coalesce(url.startswith("#") & (url != "#") & ~url.contains("://") & ~url.contains("?") & ~url.contains("&"), F.lit(False))


def is_relative(url: Column) -> Column:
    return F.coalesce((url != "") & ~is_external(url) & ~is_anchor(url) & ~url.startswith("/"), F.lit(False))


def is_cross_document(url: Column) -> Column:
    """A target that ends, before its anchor, in a name with a Markdown suffix."""
    name = F.element_at(F.split(F.rtrim(F.substring_index(url, "#", 1), F.lit("/")), "/"), -1)
    suffix = functools.reduce(lambda a, b: a | b, [F.lower(name).endswith(s) & (F.length(name) > len(s)) for s in tables.MARKDOWN_SUFFIXES])
    return F.coalesce((url != "") & ~is_external(url) & ~is_anchor(url) & suffix, F.lit(False))


def target_document(url: Column) -> Column:
    return F.when(is_cross_document(url), F.substring_index(url, "#", 1))


def anchor_of(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, "#(.+)$", 1), F.lit(""))
