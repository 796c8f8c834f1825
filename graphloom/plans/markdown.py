"""Queries over Markdown documents that are put together from customers' rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions.checkpoints import checkpoint
from graphloom.functions import tables, urls
from graphloom.operators import markdown as md
from graphloom.plans.base import duck, quoted, rows

_K = "CAST(c_custkey AS STRING)"
_N = "chr(10)"
#: Lines of each document; NULL lines are left out.
_PARTS = [
    f"CASE WHEN c_custkey % 4 = 0 THEN '---' || {_N} || 'title: \"T' || {_K} || '\"' || {_N} || 'version: 1.' || CAST(c_custkey % 9 AS STRING) || {_N} || '---' END",
    "'# ' || c_name || ' Guide_2.0'",
    "''",
    "'Intro by Open ' || lower(c_mktsegment) || ' with [link one](docs/spec.md#part \"The title\") and [two](https://example.com/a)'",
    "'second line <https://example.com/x> of [3] and [12] and [3]  '",
    "CASE WHEN c_custkey % 3 = 0 THEN '### Deep ' || c_mktsegment END",
    "CASE WHEN c_custkey % 5 < 3 THEN '## Part A. ' || " + _K + " END",
    "CASE WHEN c_custkey % 2 = 0 THEN '- item ' || " + _K + " END",
    "CASE WHEN c_custkey % 2 = 0 THEN '* [x] done ' || c_mktsegment END",
    "CASE WHEN c_custkey % 6 = 0 THEN '  + deeper' END",
    "CASE WHEN c_custkey % 3 = 1 THEN '7. seven' || chr(10) || '8) eight' END",
    "'Table of ' || c_mktsegment",
    "CASE WHEN c_custkey % 7 <> 0 THEN '' END",
    "CASE WHEN c_custkey % 8 = 1 THEN 'not | a header' END",
    "CASE WHEN c_custkey % 3 <> 2 THEN '| Key | Name | Balance |' || chr(10) || '|:---|:-:|--:|' || chr(10) || '| ' || " + _K + " || ' | ' || c_name || ' | x |' END",
    "CASE WHEN c_custkey % 6 = 1 THEN '| 1 | 2 |' || chr(10) || '| 3 |' || chr(10) || '| 4 | 5 | 6 |' END",
    "CASE WHEN c_custkey % 5 = 2 THEN '| lonely | row |' END",
    "'#### Last | one'",
    "CASE WHEN c_custkey % 4 < 2 THEN '```json' || chr(10) || '{\"k\": ' || " + _K + " || '}' || chr(10) || '~~~' || chr(10) || '# no heading' || chr(10) || 'x' || chr(10) || 'y' || chr(10) || 'z' || chr(10) || '```' END",
    "CASE WHEN c_custkey % 9 = 0 THEN '~~~' || chr(10) || 'open' END",
    "'![alt](img/' || " + _K + " || '.png) ![](/abs.png \"P\") and [up](#part-a-' || " + _K + " || ')'",
    "'[ref]: ./other.markdown \"Other\"'",
    "'A note[^n1] and [^n2] again[^n1].'",
    "'[^n1]: first text'",
    "CASE WHEN c_custkey % 2 = 1 THEN '[^n1]: second text' END",
    "CASE WHEN c_custkey % 11 = 0 THEN '> quote' || chr(10) || '***' END",
    "CASE WHEN c_custkey % 3 = 0 THEN '## Part A. 2 ' ELSE 'the end' END",
]
DOCS = "SELECT c_custkey AS doc_id, concat_ws(chr(10), " + ", ".join(_PARTS) + ") || CASE WHEN c_custkey % 2 = 0 THEN chr(10) ELSE '' END AS text FROM @customer"
TARGETS = """SELECT page_id, CASE page_id % 9 WHEN 0 THEN url WHEN 1 THEN '../docs/' || CAST(page_id AS STRING) || '.MD#part' WHEN 2 THEN '#section-' || CAST(page_id AS STRING) WHEN 3 THEN '#' WHEN 4 THEN '/abs/x.md'
  WHEN 5 THEN 'mailto:abc' WHEN 6 THEN '#a?b' WHEN 7 THEN 'img/' || CAST(page_id AS STRING) || '.png' ELSE '.md' END AS url FROM @pages"""


PAGED = "SELECT l_suppkey AS doc_id, 'Part ' || CAST(l_linenumber AS STRING) || '.' AS heading, 1 + CAST(l_partkey % 7 AS INT) AS page FROM @lineitem"
NAMED = "SELECT s_suppkey AS doc_id, 3 AS pos, '03_part_5' AS name FROM @supplier UNION ALL SELECT s_suppkey, 1, '01_part_2' FROM @supplier UNION ALL SELECT s_suppkey, 2, '02_gone' FROM @supplier"


def doc_rows(spark, d):
    return rows(spark, d, DOCS, customer="c_custkey")


def line_rows(spark, d):
    return md.lines(doc_rows(spark, d))


def with_sections(f):
    return lambda spark, d: f(md.parents(md.sections(line_rows(spark, d))))


def containers(spark, d):
    """Sections and paragraphs that references may stand in, each by itself."""
    ls = line_rows(spark, d)
    return md.first_container(md.references(ls).where("kind <> 'image'"), md.sections(ls)).select("doc_id", "line", "kind", "nth", "container")


def paragraph_containers(spark, d):
    ls = checkpoint(line_rows(spark, d))
    return md.first_container(md.references(ls), md.paragraphs(ls)).select("doc_id", "line", "kind", "nth", "container")


def content(spark, d):
    ls = checkpoint(line_rows(spark, d))  # cut once, for all kinds of blocks
    blocks = [("heading", md.headings(ls).select("doc_id", F.col("line").alias("start"))), ("table", md.tables(ls)), ("list", md.lists(ls)), ("paragraph", md.paragraphs(ls)), ("code", md.code_blocks(ls))]
    every = None
    for kind, f in blocks:
        part = f.select("doc_id", "start", F.lit(kind).alias("kind"))
        every = part if every is None else every.union(part)
    return md.section_of(md.sections(ls), every).select("doc_id", "section", "kind", "start")


def joined(c: str, by: str = "|"):
    return F.array_join(c, by).alias(c)


D_DOCS = duck(DOCS)
D_LINES = f"""SELECT doc_id, CAST(k AS INTEGER) AS line, ls[k] AS raw, trim(ls[k], ' ' || chr(9) || chr(10) || chr(13)) AS text FROM (
  SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT doc_id, CASE WHEN text LIKE '%' || chr(10) THEN string_split(text[:-2], chr(10)) ELSE string_split(text, chr(10)) END AS ls FROM ({D_DOCS})))"""
D_LEVEL = "length(regexp_extract(text, '^(#{1,6}) ', 1))"
D_SLUG = "trim(regexp_replace(regexp_replace(lower(name), '[\\s_.]+', '-', 'g'), '[^\\w-]', '', 'g'), '-')"
D_HEADS = f"SELECT *, {D_SLUG} AS slug FROM (SELECT doc_id, line, {D_LEVEL} AS level, trim(ltrim(text, '#')) AS name FROM ({D_LINES}) WHERE {D_LEVEL} > 0)"
D_SECTIONS = f"""SELECT h.doc_id, h.line AS start, coalesce(lead(h.line) OVER (PARTITION BY h.doc_id ORDER BY h.line) - 1, n) AS "end", level, name, slug FROM ({D_HEADS}) h JOIN (SELECT doc_id, max(line) AS n FROM ({D_LINES}) GROUP BY 1) t USING (doc_id)"""
D_SHOWN = f"""SELECT s.*, CASE WHEN length(b) > 200 THEN b[1:200] || '...' ELSE coalesce(b, '') END AS preview FROM ({D_SECTIONS}) s LEFT JOIN (
  SELECT s.doc_id, s.start, string_agg(text, ' ' ORDER BY line) AS b FROM ({D_SECTIONS}) s JOIN ({D_LINES}) l ON l.doc_id = s.doc_id AND l.line > s.start AND l.line <= s."end" AND text <> '' GROUP BY ALL) x USING (doc_id, start)"""
D_PARENTS = f"SELECT s.*, (SELECT max(p.start) FROM ({D_SECTIONS}) p WHERE p.doc_id = s.doc_id AND p.start < s.start AND p.level < s.level) AS parent FROM ({D_SECTIONS}) s"
D_PATHS = f"""WITH RECURSIVE s AS ({D_PARENTS}), up AS (SELECT doc_id, start, parent, name AS path, 0 AS depth FROM s UNION ALL SELECT up.doc_id, up.start, s.parent, s.name || ' / ' || up.path, up.depth + 1 FROM up JOIN s ON s.doc_id = up.doc_id AND s.start = up.parent)
SELECT doc_id, start, path, depth FROM up WHERE parent IS NULL"""


def d_islands(inside: str, kind: str = "0") -> str:
    return f"""SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS run FROM (
    SELECT *, lag(line) OVER w IS DISTINCT FROM line - 1 OR lag(kind) OVER w IS DISTINCT FROM kind AS fresh FROM (SELECT *, {kind} AS kind FROM ({D_LINES}) WHERE {inside}) WINDOW w AS (PARTITION BY doc_id ORDER BY line))"""


D_CELLS = "list_transform(string_split(trim(trim({x}), '|'), '|'), lambda c: trim(c))"
D_TABLE_LINES = f"""SELECT *, min(CASE WHEN split THEN line END) OVER (PARTITION BY doc_id, run) AS start FROM (
  SELECT *, coalesce(regexp_matches(lead(raw) OVER (PARTITION BY doc_id, run ORDER BY line), '{md.SEPARATOR}'), false) AS split FROM ({d_islands("contains(text, '|')")}))"""
D_TABLES = f"""SELECT t.doc_id, t.start, t."end", {D_CELLS.format(x='ls[1]')} AS headers, list_transform({D_CELLS.format(x='ls[2]')}, lambda c: CASE WHEN c LIKE ':%' AND c LIKE '%:' THEN 'center' WHEN c LIKE '%:' THEN 'right' ELSE 'left' END) AS alignment,
  len(ls) - 2 AS n_rows, len({D_CELLS.format(x='ls[1]')}) AS n_columns, list_transform(ls[3:5], lambda r: array_to_string({D_CELLS.format(x='r')}, ',')) AS preview,
  (SELECT CASE WHEN contains(l.text, '|') THEN NULL ELSE l.text END FROM ({D_LINES}) l WHERE l.doc_id = t.doc_id AND l.line < t.start AND l.text <> '' ORDER BY l.line DESC LIMIT 1) AS caption
FROM (SELECT doc_id, start, max(line) AS "end", list(raw ORDER BY line) AS ls FROM ({D_TABLE_LINES}) WHERE line >= start GROUP BY doc_id, start) t"""
D_KIND = "CASE WHEN regexp_matches(text, '^[-*+]\\s+') THEN 'unordered' WHEN regexp_matches(text, '^\\d+[.)]\\s+') THEN 'ordered' END"
D_LISTS = f"""SELECT doc_id, min(line) AS start, max(line) AS "end", any_value(kind) AS kind, count(*) AS n_items, array_to_string(list_transform(list(regexp_replace(regexp_replace(text, '^[-*+]\\s+(\\[[ xX]\\]\\s+)?', ''), '^\\d+[.)]\\s+', '') ORDER BY line)[1:3], lambda x: x[1:50]), '|') AS preview,
  coalesce(min_by(try_cast(regexp_extract(text, '^(\\d+)[.)]', 1) AS INTEGER), line), 1) AS first_number FROM ({d_islands(f"{D_KIND} IS NOT NULL", D_KIND)}) GROUP BY doc_id, run"""
D_PARAGRAPH = f"text <> '' AND NOT starts_with(text, '#') AND NOT regexp_matches(text, '{md.LIST_ITEM}') AND NOT contains(text, '|') AND NOT regexp_matches(text, '{md.FENCE}') AND NOT starts_with(text, '>') AND NOT regexp_matches(text, '^[-*_]{{3,}}$')"
D_PARAGRAPHS = f"""SELECT doc_id, start, "end", len(list_filter(regexp_split_to_array(b, '\\s+'), lambda w: w <> '')) AS n_words, CASE WHEN length(b) > 200 THEN b[1:200] || '...' ELSE b END AS preview FROM (
  SELECT doc_id, min(line) AS start, max(line) AS "end", string_agg(text, ' ' ORDER BY line) AS b FROM ({d_islands(D_PARAGRAPH)}) GROUP BY doc_id, run)"""
#: Blocks by recursion over fences: the first fence opens, the next one with its mark closes.
D_CODE = f"""WITH RECURSIVE fence AS (SELECT doc_id, line, text[1:3] AS mark, trim(text[4:]) AS rest FROM ({D_LINES}) WHERE regexp_matches(text, '{md.FENCE}')),
block(doc_id, start, stop, language) AS (
  SELECT doc_id, line, (SELECT min(g.line) FROM fence g WHERE g.doc_id = f.doc_id AND g.line > f.line AND g.mark = f.mark), rest FROM fence f WHERE line = (SELECT min(line) FROM fence g WHERE g.doc_id = f.doc_id)
  UNION ALL SELECT f.doc_id, f.line, (SELECT min(g.line) FROM fence g WHERE g.doc_id = f.doc_id AND g.line > f.line AND g.mark = f.mark), f.rest FROM block b JOIN fence f ON f.doc_id = b.doc_id AND f.line = (SELECT min(g.line) FROM fence g WHERE g.doc_id = b.doc_id AND g.line > b.stop))
SELECT doc_id, start, stop AS "end", coalesce(nullif(language, ''), 'plaintext') AS language, CAST(stop - start - 1 AS INTEGER) AS n_lines,
  coalesce((SELECT string_agg(raw, chr(10) ORDER BY line) FROM ({D_LINES}) l WHERE l.doc_id = block.doc_id AND l.line > start AND l.line < least(stop, start + 6)), '') || CASE WHEN stop - start - 1 > 5 THEN chr(10) || '...' ELSE '' END AS preview
FROM block WHERE stop IS NOT NULL"""


def d_matches(pattern: str, names: tuple[str, ...], where: str = "true") -> str:
    groups = ", ".join(f"nullif(regexp_extract(m, {quoted(pattern)}, {k}), '') AS {n}" for k, n in enumerate(names, 1))
    return f"SELECT doc_id, line, CAST(nth - 1 AS INTEGER) AS nth, {groups} FROM (SELECT doc_id, line, unnest(range(1, len(ms) + 1)) AS nth, unnest(ms) AS m FROM (SELECT doc_id, line, regexp_extract_all(raw, {quoted(pattern)}) AS ms FROM ({D_LINES}) WHERE {where}))"


def d_external(u: str) -> str:
    return "(" + " OR ".join(f"starts_with({u}, '{s}')" for s in tables.EXTERNAL_SCHEMES) + ")"


def d_anchor(u: str) -> str:
    return f"(starts_with({u}, '#') AND {u} <> '#' AND NOT regexp_matches({u}, '://|[?&]'))"


def d_cross(u: str) -> str:
    return f"({u} <> '' AND NOT {d_external(u)} AND NOT {d_anchor(u)} AND regexp_matches(lower(string_split({u}, '#')[1]), '[^/](\\.md|\\.markdown|\\.mdown|\\.mkd)/*$'))"


D_LINKS = f"SELECT *, CASE WHEN {d_cross('url')} THEN string_split(url, '#')[1] END AS target_document FROM ({d_matches(md.LINK, ('name', 'url', 'title'))})"
D_IMAGES = f"SELECT *, coalesce(alt, 'Image') AS name, url <> '' AND NOT {d_external('url')} AND NOT {d_anchor('url')} AND NOT starts_with(url, '/') AS relative FROM ({d_matches(md.IMAGE, ('alt', 'url', 'title'))})"
D_DEFINITIONS = d_matches(md.DEFINITION, ("name", "url", "title"))
D_AUTOLINKS = d_matches(md.AUTOLINK, ("url",))
#: The other engine has no look-ahead: a reference is a mark that isn't followed by a colon, so one more character is read.
D_NOTES = f"SELECT doc_id, line, CAST(nth - 1 AS INTEGER) AS nth, label FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth, label FROM (SELECT doc_id, line, k, regexp_extract(parts[k], '^([^\\]]+)\\]', 1) AS label, parts[k] AS p FROM (SELECT doc_id, line, parts, unnest(range(2, len(parts) + 1)) AS k FROM (SELECT doc_id, line, string_split(raw, '[^') AS parts FROM ({D_LINES})))) WHERE label <> '' AND NOT regexp_matches(p, '^[^\\]]+\\]:'))"
D_FOOTNOTES = f"""SELECT n.*, definition_line, content FROM ({D_NOTES}) n LEFT JOIN (SELECT doc_id, label, max(line) AS definition_line, max_by(content, line) AS content FROM (
  SELECT doc_id, line, regexp_extract(raw, '{md.FOOTNOTE_TEXT}', 1) AS label, regexp_extract(raw, '{md.FOOTNOTE_TEXT}', 2) AS content FROM ({D_LINES}) WHERE regexp_matches(raw, '{md.FOOTNOTE_TEXT}')) GROUP BY ALL) d USING (doc_id, label)"""
D_REFS = f"""SELECT doc_id, line, 'link' AS kind, nth, name, url FROM ({D_LINKS}) UNION ALL SELECT doc_id, line, 'image', nth, name, url FROM ({D_IMAGES}) UNION ALL SELECT doc_id, line, 'reference_definition', nth, name, url FROM ({D_DEFINITIONS})
UNION ALL SELECT doc_id, line, 'autolink', nth, url, url FROM ({D_AUTOLINKS}) UNION ALL SELECT doc_id, line, 'footnote', nth, 'Footnote ' || label, NULL FROM ({D_FOOTNOTES})"""
D_CONTENT = f"""SELECT doc_id, line AS start, 'heading' AS kind FROM ({D_HEADS}) UNION ALL SELECT doc_id, start, 'table' FROM ({D_TABLES}) UNION ALL SELECT doc_id, start, 'list' FROM ({D_LISTS}) UNION ALL SELECT doc_id, start, 'paragraph' FROM ({D_PARAGRAPHS}) UNION ALL SELECT doc_id, start, 'code' FROM ({D_CODE})"""


def d_next(source: str) -> str:
    return f"SELECT doc_id, start, lead(start) OVER (PARTITION BY doc_id ORDER BY start) AS next FROM ({source})"


_ALL = {
    "CONTAINS": f"SELECT 0 AS source, start AS target FROM ({D_SECTIONS}) WHERE level = 1", "PARENT_SECTION": f"SELECT start, parent FROM ({D_PARENTS}) WHERE parent IS NOT NULL",
    "NEXT_SIBLING": f"SELECT start, lead(start) OVER (PARTITION BY doc_id, parent ORDER BY start) FROM ({D_PARENTS})", "FIRST_CHILD": f"SELECT parent, min(start) FROM ({D_PARENTS}) WHERE parent IS NOT NULL GROUP BY doc_id, parent",
    "TITLED_BY": f"SELECT s.start, min(h.line) FROM ({D_SECTIONS}) s JOIN ({D_HEADS}) h ON h.doc_id = s.doc_id AND abs(h.line - s.start) <= 2 GROUP BY s.doc_id, s.start",
    "HAS_FRONTMATTER": f"SELECT 0, 1 FROM ({D_DOCS}) WHERE starts_with(text, '---')",
    "REFERENCES": f"""SELECT s.start, r.line FROM ({D_REFS}) r JOIN ({D_SECTIONS}) s ON s.doc_id = r.doc_id AND r.line BETWEEN s.start AND s."end" """,
    "LINKS_TO": f"SELECT line, start FROM ({D_REFS}) r JOIN ({D_SECTIONS}) s ON s.doc_id = r.doc_id AND r.url = '#' || slug WHERE {d_anchor('url')}",
    "NEXT_REFERENCE": f"SELECT line, lead(line) OVER (PARTITION BY doc_id ORDER BY line) FROM ({D_REFS})",
    "NEXT_HEADING": f"SELECT line, lead(line) OVER (PARTITION BY doc_id ORDER BY line) FROM ({D_HEADS})", "NEXT_TABLE": f"SELECT start, lead(start) OVER (PARTITION BY doc_id ORDER BY start) FROM ({D_TABLES})", "NEXT_LIST": f"SELECT start, lead(start) OVER (PARTITION BY doc_id ORDER BY start) FROM ({D_LISTS})",
} | {f"HAS_{k.upper()}": f"""SELECT s.start, c.start FROM ({D_CONTENT}) c JOIN ({D_SECTIONS}) s ON s.doc_id = c.doc_id AND c.start BETWEEN s.start AND s."end" WHERE kind = '{k}'""" for k in ("heading", "table", "list", "paragraph", "code")}
D_EDGES = " UNION ALL ".join(f"SELECT '{k}' AS type, count(*) AS n, CAST(sum(source) AS BIGINT) AS sources, CAST(sum(target) AS BIGINT) AS targets FROM (SELECT * FROM ({sql}) t(source, target) WHERE target IS NOT NULL) HAVING count(*) > 0" for k, sql in _ALL.items())


def nexts(f):
    return lambda spark, d: md.next_of(f(line_rows(spark, d)), "start").select("doc_id", "start", "next")


QUERIES = {
    "md_lines": lambda spark, d: line_rows(spark, d),
    "md_headings": lambda spark, d: md.headings(line_rows(spark, d)).drop("slug"),
    "md_slugs": lambda spark, d: md.headings(line_rows(spark, d)).select("doc_id", "line", "slug"),
    "md_sections": lambda spark, d: md.sections(line_rows(spark, d)),
    "md_parent": with_sections(lambda s: s.select("doc_id", "start", "parent")),
    "md_siblings": with_sections(lambda s: md.siblings(s).select("doc_id", "start", "next")),
    "md_first_child": with_sections(md.first_children),
    "md_depth_path": with_sections(lambda s: md.depth_and_path(s).select("doc_id", "start", "path", "depth")),
    "md_document_sections": with_sections(md.document_sections),
    "md_content_range_join": content,
    "md_titled_by": lambda spark, d: md.titles(md.sections(line_rows(spark, d)), md.headings(line_rows(spark, d))),
    "md_tables": lambda spark, d: md.tables(line_rows(spark, d)).withColumn("headers", joined("headers")).withColumn("alignment", joined("alignment")).withColumn("preview", joined("preview", ";")),
    "md_table_alignment": lambda spark, d: md.tables(line_rows(spark, d)).select("doc_id", "start", F.posexplode("alignment").alias("column", "alignment")),
    "md_gfm_tables": lambda spark, d: md.gfm_tables(line_rows(spark, d)).select("doc_id", "start", joined("headers"), F.array_join(F.transform("rows", lambda r: F.array_join(r, ",")), ";").alias("rows")),
    "md_edges": lambda spark, d: md.edges(doc_rows(spark, d)).groupBy("type").agg(F.count("*").alias("n"), F.sum(F.coalesce("source", F.lit(0)).cast("long")).alias("sources"), F.sum(F.col("target").cast("long")).alias("targets")),
    "md_lists": lambda spark, d: md.lists(line_rows(spark, d)),
    "md_nested_lists": lambda spark, d: md.nested_lists(doc_rows(spark, d)),
    "md_heading_pages": lambda spark, d: md.heading_pages(rows(spark, d, PAGED), rows(spark, d, NAMED), rows(spark, d, "SELECT s_suppkey AS doc_id, 9 AS n_pages FROM @supplier")),
    "md_paragraphs": lambda spark, d: md.paragraphs(line_rows(spark, d)),
    "md_codeblocks": lambda spark, d: md.code_blocks(line_rows(spark, d)),
    "md_links": lambda spark, d: md.inline_links(line_rows(spark, d)),
    "md_images": lambda spark, d: md.images(line_rows(spark, d)),
    "md_refdefs": lambda spark, d: md.definitions(line_rows(spark, d)),
    "md_autolinks": lambda spark, d: md.autolinks(line_rows(spark, d)),
    "md_footnotes": lambda spark, d: md.footnotes(line_rows(spark, d)),
    "md_references": lambda spark, d: md.references(line_rows(spark, d)).drop("order"),
    "md_ref_first_container": containers,
    "md_ref_paragraph_container": paragraph_containers,
    "md_summary": lambda spark, d: md.summary(checkpoint(line_rows(spark, d))),
    "md_anchor_links": lambda spark, d: md.anchor_links(md.references(line_rows(spark, d)), md.sections(line_rows(spark, d))).select("doc_id", "line", "nth", "slug", "section"),
    "md_next_heading": nexts(lambda ls: md.headings(ls).withColumnRenamed("line", "start")),
    "md_next_table": nexts(md.tables),
    "md_next_list": nexts(md.lists),
    "md_frontmatter": lambda spark, d: md.frontmatter(doc_rows(spark, d)).select("doc_id", "raw", F.try_element_at("fields", F.lit("title")).alias("title"), F.try_element_at("fields", F.lit("version")).alias("version")),
    "md_citations": lambda spark, d: md.citations(doc_rows(spark, d)).select("doc_id", joined("citations")),
    "md_title": lambda spark, d: md.title(line_rows(spark, d)),
    "url_classify": lambda spark, d: rows(spark, d, TARGETS).select("page_id", *[f(F.col("url")).alias(n) for n, f in (("external", urls.is_external), ("anchor", urls.is_anchor), ("relative", urls.is_relative), ("cross", urls.is_cross_document), ("document", urls.target_document), ("fragment", urls.anchor_of))]),
}

ORACLES = {
    "md_lines": D_LINES,
    "md_headings": f"SELECT doc_id, line, CAST(level AS INTEGER) AS level, name FROM ({D_HEADS})",
    "md_slugs": f"SELECT doc_id, line, slug FROM ({D_HEADS})",
    "md_sections": f"SELECT * REPLACE (CAST(level AS INTEGER) AS level) FROM ({D_SHOWN})",
    "md_parent": f"SELECT doc_id, start, parent FROM ({D_PARENTS})",
    "md_siblings": f"SELECT doc_id, start, lead(start) OVER (PARTITION BY doc_id, parent ORDER BY start) AS next FROM ({D_PARENTS})",
    "md_first_child": f"SELECT doc_id, parent, min(start) AS child FROM ({D_PARENTS}) WHERE parent IS NOT NULL GROUP BY ALL",
    "md_depth_path": D_PATHS,
    "md_document_sections": f"SELECT doc_id, start FROM ({D_SECTIONS}) WHERE level = 1",
    "md_content_range_join": f"""SELECT c.doc_id, s.start AS section, kind, c.start FROM ({D_CONTENT}) c JOIN ({D_SECTIONS}) s ON s.doc_id = c.doc_id AND c.start BETWEEN s.start AND s."end" """,
    "md_titled_by": f"SELECT s.doc_id, s.start, min(h.line) AS heading FROM ({D_SECTIONS}) s JOIN ({D_HEADS}) h ON h.doc_id = s.doc_id AND abs(h.line - s.start) <= 2 GROUP BY ALL",
    "md_tables": f"SELECT * REPLACE (array_to_string(headers, '|') AS headers, array_to_string(alignment, '|') AS alignment, array_to_string(preview, ';') AS preview, CAST(n_rows AS INTEGER) AS n_rows, CAST(n_columns AS INTEGER) AS n_columns) FROM ({D_TABLES})",
    "md_table_alignment": f"SELECT doc_id, start, CAST(k - 1 AS INTEGER) AS column, alignment[k] AS alignment FROM (SELECT doc_id, start, alignment, unnest(range(1, len(alignment) + 1)) AS k FROM ({D_TABLES}))".replace(" AS column", ' AS "column"'),
    "md_gfm_tables": f"""SELECT doc_id, start, array_to_string(h, '|') AS headers, array_to_string(list_transform(ls[3:], lambda r: array_to_string(list_transform(range(1, len(h) + 1), lambda i: coalesce({D_CELLS.format(x='r')}[i], '')), ',')), ';') AS rows
      FROM (SELECT *, {D_CELLS.format(x='ls[1]')} AS h FROM (SELECT doc_id, run, min(line) AS start, list(raw ORDER BY line) AS ls FROM ({d_islands("contains(text, '|')")}) GROUP BY doc_id, run)) WHERE regexp_matches(ls[2], '{md.SEPARATOR}')""",
    "md_edges": D_EDGES,
    "md_lists": D_LISTS,
    "md_heading_pages": f"""SELECT doc_id, name, "from", coalesce(lead("from") OVER (PARTITION BY doc_id ORDER BY pos), 9) AS "to" FROM (SELECT n.doc_id, n.pos, n.name, min(p.page) AS "from" FROM ({duck(NAMED)}) n JOIN ({duck(PAGED)}) p ON p.doc_id = n.doc_id AND trim(regexp_replace(lower(p.heading), '[^a-z0-9]+', '_', 'g'), '_') = regexp_replace(n.name, '^[0-9]+_', '') GROUP BY ALL)""",
    "md_paragraphs": f"SELECT * REPLACE (CAST(n_words AS INTEGER) AS n_words) FROM ({D_PARAGRAPHS})",
    "md_codeblocks": D_CODE,
    "md_links": D_LINKS,
    "md_images": D_IMAGES,
    "md_refdefs": D_DEFINITIONS,
    "md_autolinks": D_AUTOLINKS,
    "md_footnotes": D_FOOTNOTES,
    "md_references": D_REFS,
    "md_ref_paragraph_container": f"""SELECT r.doc_id, r.line, kind, nth, min(p.start) AS container FROM ({D_REFS}) r JOIN ({D_PARAGRAPHS}) p ON p.doc_id = r.doc_id AND r.line BETWEEN p.start AND p."end" GROUP BY ALL""",
    "md_summary": "SELECT doc_id, " + ", ".join(f"count(*) FILTER (kind = '{k}') AS {k}" for k in ("sections", "tables", "lists", "paragraphs", "code_blocks", "references")) + " FROM (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind FROM ({sql})" for k, sql in (("sections", D_HEADS), ("tables", D_TABLES), ("lists", D_LISTS), ("paragraphs", D_PARAGRAPHS), ("code_blocks", D_CODE), ("references", D_REFS))) + ") GROUP BY doc_id",
    "md_ref_first_container": f"""SELECT r.doc_id, r.line, kind, nth, min(s.start) AS container FROM ({D_REFS}) r JOIN ({D_SECTIONS}) s ON s.doc_id = r.doc_id AND r.line BETWEEN s.start AND s."end" WHERE kind <> 'image' GROUP BY ALL""",
    "md_anchor_links": f"SELECT r.doc_id, line, nth, slug, start AS section FROM ({D_REFS}) r JOIN ({D_SECTIONS}) s ON s.doc_id = r.doc_id AND r.url = '#' || slug WHERE {d_anchor('url')}",
    "md_next_heading": d_next(f"SELECT doc_id, line AS start FROM ({D_HEADS})"),
    "md_next_table": d_next(D_TABLES),
    "md_next_list": d_next(D_LISTS),
    "md_frontmatter": f"SELECT doc_id, raw, nullif(regexp_extract(raw, 'title: \"(.*)\"', 1), '') AS title, nullif(regexp_extract(raw, 'version: (.*)', 1), '') AS version FROM (SELECT doc_id, regexp_extract(text, '(?s)\\A---[ \\t]*\\n(.*?)\\n---[ \\t]*(?:\\n|\\z)', 1) AS raw FROM ({D_DOCS})) WHERE raw <> ''",
    "md_citations": f"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{md.CITATION}', 1))), '|') AS citations FROM ({D_DOCS})",
    "md_title": f"SELECT doc_id, trim(min_by(text, line)[3:]) AS title FROM ({D_LINES}) WHERE starts_with(text, '# ') GROUP BY doc_id",
    "url_classify": f"SELECT page_id, {d_external('url')} AS external, {d_anchor('url')} AS anchor, url <> '' AND NOT {d_external('url')} AND NOT {d_anchor('url')} AND NOT starts_with(url, '/') AS relative, {d_cross('url')} AS cross, CASE WHEN {d_cross('url')} THEN string_split(url, '#')[1] END AS document, nullif(regexp_extract(url, '#(.+)$', 1), '') AS fragment FROM ({duck(TARGETS)})".replace(" AS cross,", ' AS "cross",'),
}
