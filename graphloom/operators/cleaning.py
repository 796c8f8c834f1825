"""Cleaning of texts that were converted from pages: contents, headings, images, noise, page numbers, wrapped lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.names import let, strip

#: A line that comes so often and is shorter than this is noise.
REPEATED, SHORT = 3, 120
#: Rows with dot leaders that make a table a table of contents: at least so many, and this share of all.
LEADERS, SHARE = 3, 0.4
_TABLE = r"(?:\|[^\n]+\|\n)(?:\|[-| :]+\|\n)((?:\|[^\n]+\|\n)+)"
_NUMBERED = r"^#{1,6} (\d+(?:\.\d+)*) (.+)$"


def relevel(text: Column) -> Column:
    """Numbered headings get as many marks as their number has parts, four at most."""
    def line(x: Column) -> Column:
        number = F.regexp_extract(x, _NUMBERED, 1)
        return F.when(number == "", x).otherwise(F.concat_ws(" ", F.repeat(F.lit("#"), F.least(F.size(F.split(number, r"\.")), F.lit(4))), number, F.regexp_extract(x, _NUMBERED, 2)))

    return F.array_join(F.transform(F.split(text, "\n"), line), "\n")


def number_images(text: Column) -> Column:
    parts = F.split(text, r"<!--\s*image\s*-->", -1)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("*[Figure "), i.cast("string"), F.lit(": diagram or image -- not extracted]*"), p))), "")


def without_noise(text: Column) -> Column:
    """Without the lines that, trimmed, come often and are short. Counting stays inside the row, by sorting its lines."""
    def noise(lines: Column) -> Column:
        sorted_ = F.array_sort(F.filter(F.transform(lines, strip), lambda x: x != ""))
        again = lambda all_: F.filter(all_, lambda x, i: x == F.get(all_, i + (REPEATED - 1)))
        return F.filter(F.array_distinct(let(sorted_, again)), lambda x: F.length(x) < SHORT)

    kept = lambda lines: let(noise(lines), lambda listed: F.filter(lines, lambda x: ~F.array_contains(listed, strip(x))))
    return F.array_join(let(F.split(text, "\r\n|[\n\r]"), kept), "\n")


def noise_lines(lines: DataFrame) -> DataFrame:
    """The same by a count over rows of lines: ``doc_id``, ``text``, ``n``."""
    return lines.where("text <> ''").groupBy("doc_id", "text").agg(F.count("*").alias("n")).where((F.col("n") >= REPEATED) & (F.length("text") < SHORT))


def without_page_numbers(text: Column) -> Column:
    for p in (r"(?m)^\s*Page\s+\d+\s+of\s+\d+\s*$", r"(?m)^\s*-\s*\d+\s*-\s*$", r"(?m)^\s*\d+\s*$"):
        text = F.regexp_replace(text, p, "")
    return text


def unwrapped(text: Column) -> Column:
    """Lines that go on in lower case are joined, unless the line before ends a sentence or a word part."""
    return F.regexp_replace(text, r"(?<![.!?:\-])\n(?=[a-z])", " ")


def squeezed(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text, "[ \t]+", " "), "\n{3,}", "\n\n"))


def _entry(row: Column) -> Column:
    """A row of a table of contents as a list item, null if it has no title."""
    cells = F.filter(F.transform(F.split(F.regexp_replace(row, r"^\|+|\|+$", ""), r"\|"), lambda c: strip(c)), lambda c: c != "")
    leader = r"\.{3,}\s*\d+\s*$"

    def parts(cells: Column) -> Column:
        numbered = F.get(cells, F.lit(0)).rlike(r"^\d[\d.]*$")
        rest = F.when(numbered, F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))).otherwise(cells)
        body = let(rest, lambda r: F.coalesce(F.get(F.filter(r, lambda c: c.rlike(leader)), F.lit(0)), F.get(r, F.lit(0))))
        return F.struct(F.when(numbered, F.get(cells, F.lit(0))).otherwise("").alias("section"), body.alias("body"))

    def entry(p: Column) -> Column:
        section, body = p["section"], p["body"]
        title = F.when(body.rlike(leader), strip(F.regexp_extract(body, r"^(.*?)\s*\.{3,}\s*(\d+)\s*$", 1))).otherwise(strip(body))
        page = F.when(body.rlike(leader), F.concat(F.lit(" -- p."), F.regexp_extract(body, r"^(.*?)\s*\.{3,}\s*(\d+)\s*$", 2))).otherwise("")
        indent = F.when(section == "", "").otherwise(F.repeat(F.lit("  "), F.size(F.split(section, r"\.")) - 1))
        return let(title, lambda t: F.when(t != "", F.concat(indent, F.lit("- "), F.when(section == "", "").otherwise(F.concat(F.lit("**"), section, F.lit("**  "))), t, page)))

    return let(let(cells, parts), entry)


def contents_list(text: Column) -> Column:
    """Tables of contents as nested lists; other tables stay."""
    tables = F.regexp_extract_all(text, F.lit(f"({_TABLE})"), F.lit(1))
    between = F.split(text, _TABLE, -1)

    def one(t: Column) -> Column:
        def made(rows: Column) -> Column:
            dotted = F.size(F.filter(rows, lambda r: r.rlike(r"\.{4,}\s*\d+")))
            listed = F.concat(F.array_join(F.filter(F.transform(rows, lambda r: _entry(r)), lambda e: e.isNotNull()), "\n"), F.lit("\n"))
            return let(dotted, lambda d: F.when((d >= LEADERS) & (d >= F.size(rows) * SHARE), listed).otherwise(t))

        return let(F.split(strip(F.regexp_extract(t, _TABLE, 1)), "\n"), made)

    put = lambda done: F.transform(between, lambda b, i: F.concat(b, F.coalesce(F.get(done, i), F.lit(""))))
    return F.array_join(let(F.transform(tables, one), put), "")


def cleaned(docs: DataFrame, column: str = "text") -> DataFrame:
    """All steps in order, each a projection of its own."""
    for step in (contents_list, relevel, number_images, without_noise, without_page_numbers, unwrapped, squeezed):
        docs = docs.withColumn(column, step(F.col(column)))
    return docs
