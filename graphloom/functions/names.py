"""Rules for names and types, as column expressions. A rule returns null where it has nothing to say."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import tables


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The value of a key in a small table, null if it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


#: All that Unicode counts as white space.
SPACES = "\t\n\x0b\x0c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Take white space of any kind off both ends."""
    return F.btrim(c, F.lit(SPACES))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once: what an expression inside a lambda refers to is computed for every element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def first_non_blank(*columns: Column | str) -> Column:
    """The first value that isn't null, empty or only white space, without the white space around it."""
    return F.coalesce(*[F.nullif(strip(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")), F.lit("")) for c in columns])


def pascal_case(c: Column) -> Column:
    """``payment_initiation``, ``paymentInitiation`` and ``PAYMENT-INITIATION`` all become ``PaymentInitiation``."""
    spaced = F.regexp_replace(F.regexp_replace(c, r"([a-z\p{Nd}])([A-Z])", "$1 $2"), "([A-Z])([A-Z][a-z])", "$1 $2")
    parts = F.filter(F.split(spaced, r"(?U)[\s_\-./\\|]+"), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substr(p, F.lit(1), F.lit(1))), F.lower(F.substr(p, F.lit(2))))), "")


def casing(c: Column) -> Column:
    return F.nullif(pascal_case(c), F.lit(""))


def abbreviations(c: Column, table: dict[str, str] = tables.ABBREVIATIONS) -> Column:
    """Whole runs of capitals that the table knows, as it writes them."""
    return functools.reduce(lambda x, k: F.regexp_replace(x, f"(?<![A-Z]){k}(?![A-Z])", table[k]), [k for k in table if k.isalpha() and len(k) > 1], c)


def java_name(c: Column) -> Column:
    """A class name without the first role suffix that it ends with; a name that is a suffix stays."""
    name = strip(c)
    return F.coalesce(*[F.when(name.endswith(s) & (F.length(name) > len(s)), F.substr(name, F.lit(1), F.length(name) - len(s))) for s in tables.JAVA_SUFFIXES], name)


def singular(c: Column) -> Column:
    """Cautious singular of a resource name."""
    low, n = F.lower(c), F.length(c)
    cut = lambda k: F.substr(c, F.lit(1), n - k)
    return F.when(low.isin(*tables.NOT_PLURAL), c).when(low.endswith("ies") & (n > 4), F.concat(cut(3), F.lit("y"))).when(low.endswith("ses") & (n > 4), cut(2)).when(low.endswith("s") & (n > 3) & ~low.endswith("ss"), cut(1)).otherwise(c)


_PREFIX = r"(?iU)^(?:" + "|".join(tables.HTTP_METHODS) + r")\s+"


def openapi_resource(c: Column) -> Column:
    """The last fixed segment of ``VERB /path/{parameter}``, in the singular."""
    path = F.regexp_replace(strip(F.regexp_replace(c, _PREFIX, "")), r"\{[^}]+\}", "")
    segments = F.filter(F.transform(F.split(path, "/"), strip), lambda s: s != "")
    return F.coalesce(singular(F.try_element_at(segments, F.lit(-1))), c)


def source_pattern(c: Column, parser: Column) -> Column:
    java = F.nullif(java_name(c), c)
    api = F.when(c.contains("/") | F.regexp_like(c, F.lit(_PREFIX)), F.nullif(openapi_resource(c), c))
    return F.when(strip(c) == "", None).when(parser.isin(*tables.JAVA_PARSERS), java).when(parser.isin(*tables.OPENAPI_PARSERS), api)


def synonym(c: Column, table: dict[str, list[str]] = tables.SYNONYMS) -> Column:
    return lookup(F.lower(c), {a.lower(): k for k, names in table.items() for a in [k, *names]})


#: The rules in the order in which they apply; each one's null keeps what the last made.
RULES = (source_pattern, lambda c, parser: casing(c), lambda c, parser: abbreviations(c), lambda c, parser: synonym(c))


def canonical_type(c: Column, table: dict[str, str] = tables.TYPES) -> Column:
    return F.coalesce(lookup(F.lower(strip(c)), table), F.lit(tables.TYPE_FALLBACK))


def match_key(c: Column) -> Column:
    """What names are compared by."""
    return F.lower(pascal_case(c))


def relation_key(c: Column) -> Column:
    """``dependsOn``, ``depends-on`` and ``DEPENDS ON`` all become ``DEPENDS_ON``."""
    spaced = F.regexp_replace(strip(c), r"([a-z\p{Nd}])([A-Z])", "$1_$2")
    return F.regexp_replace(F.upper(F.regexp_replace(spaced, r"(?U)[\s\-./]+", "_")), "^_+|_+$", "")


def canonical_relation(c: Column, table: dict[str, str] = tables.RELATIONS) -> Column:
    return F.coalesce(lookup(relation_key(c), table), F.lit(tables.RELATION_FALLBACK))


def uuid5(name: Column, namespace: str = "6ba7b8119dad11d180b400c04fd430c8") -> Column:
    """Version 5 UUID of a name; the default namespace is that of URLs."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), (F.conv(F.substr(h, F.lit(17), F.lit(1)), 16, 10).cast("int") % 4 + 1))
    cut = lambda a, n: F.substr(h, F.lit(a), F.lit(n))
    return F.concat_ws("-", cut(1, 8), cut(9, 4), F.concat(F.lit("5"), cut(14, 3)), F.concat(variant, cut(18, 3)), cut(21, 12))


def confidence(*columns: str) -> Column:
    """The first value that is a number from 0 to 1, else 1."""
    values = [F.col(c).try_cast("double") for c in columns]
    return F.coalesce(*[F.when(v.between(0, 1), v) for v in values], F.lit(1.0))


def clamp_confidence(c: Column) -> Column:
    """Into 0 to 1; null and 0 count as not given and become 1."""
    return F.least(F.greatest(F.coalesce(F.nullif(c, F.lit(0.0)), F.lit(1.0)), F.lit(0.0)), F.lit(1.0))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\w-]", "_")


def file_slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
