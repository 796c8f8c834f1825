"""Plans and rows that hold for tables of any size: what once grew faster than its input, or stood on a small estimate."""

import random

import numpy as np
import pytest

from graphloom.functions import names
from graphloom.operators import cleaning, entities, java, markdown
from graphloom.plans import registry
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def planned(spark, name):
    return registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_code_blocks_join_nothing(spark):
    """blocks were broadcast, since the planner took texts for as small as the rows they are made of."""
    assert "Join" not in planned(spark, "md_codeblocks")


def test_code_blocks(spark):
    text = "\n".join(["```a", *"123456", "```", "~~~", "~~~", "x", "```", "~~~", "y", "```", "~~~"])
    docs = spark.createDataFrame([(1, text), (2, "no fence"), (None, "```\nz\n```")], "doc_id long, text string")
    assert rows_of(markdown.code_blocks(markdown.lines(docs))) == [(1, 1, 8, "a", 6, "1\n2\n3\n4\n5\n..."), (1, 12, 15, "plaintext", 2, "~~~\ny"), (1, 9, 10, "plaintext", 0, "")]


def test_strip_knows_all_spaces(spark):
    """The list of characters is what Unicode's white space is to regular expressions."""
    every = [(k, chr(k)) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    odd = spark.createDataFrame(every, "k int, c string").where((names.strip(F.concat("c", F.lit("a b"), "c")) == "a b") != F.col("c").rlike(r"(?U)^\s$"))
    assert odd.count() == 0


def test_titles_join_nothing(spark):
    """F2"""
    assert "Join" not in planned(spark, "md_titled_by")


def test_titles(spark):
    heads = spark.createDataFrame([(1, 1), (1, 4), (1, 9), (2, 3), (None, 5)], "doc_id long, line int")
    found = spark.createDataFrame([(1, 3), (1, 6), (1, 12), (2, 1), (3, 1), (None, 5)], "doc_id long, start int")
    assert rows_of(markdown.titles(found, heads)) == [(1, 3, 1), (1, 6, 4), (2, 1, 3)]


def test_references_read_lines_once(spark):
    """each kind of reference made, cut and stripped all texts anew."""
    assert planned(spark, "md_anchor_links").count("FileScan") == 2
    assert "BroadcastExchange" not in planned(spark, "md_anchor_links")


def test_edges_join_anchors_only(spark):
    """every kind of edge but LINKS_TO goes by windows, and nothing is broadcast."""
    plan = planned(spark, "md_edges")
    assert plan.count("Join") == plan.count("SortMergeJoin") == 1


def test_first_container_of_any_shape(spark):
    """Containers that overlap, nest or begin together, against comparing all pairs."""
    deal = random.Random(5)
    refs = [(deal.randrange(6), deal.randrange(1, 30), k) for k in range(200)]
    held = [(deal.randrange(6), a, a + deal.randrange(9)) for a in (deal.randrange(1, 30) for _ in range(40))]
    want = []
    for doc, line, k in refs:
        around = [a for d, a, b in held if d == doc and a <= line <= b]
        want += [(doc, line, k, min(around))] if around else []
    found = markdown.first_container(spark.createDataFrame(refs, "doc_id int, line int, k int"), spark.createDataFrame(held, "doc_id int, start int, end int"))
    assert rows_of(found) == sorted(want, key=repr)


def test_md_sections_moves_no_lines(spark):
    """F8: documents are dealt to all cores before texts are made, and nothing is shuffled or joined after."""
    plan = planned(spark, "md_sections")
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_md_parent_moves_no_lines(spark):
    """documents are dealt to all cores before texts are made, and nothing is shuffled or joined after."""
    plan = planned(spark, "md_parent")
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def markdown_is_dealt(spark):
    return planned(spark, "md_lines").count("Exchange ") == 1


def test_md_ref_paragraph_container_joins_nothing(spark):
    """documents are dealt to all cores before texts are made, and containers are found by windows."""
    plan = registry.queries()["md_ref_paragraph_container"](spark, DATA)._jdf.queryExecution()
    assert "Join" not in plan.executedPlan().toString()
    assert markdown_is_dealt(spark)


def test_md_ref_first_container_joins_nothing(spark):
    """documents are dealt to all cores before texts are made, and containers are found by windows."""
    plan = registry.queries()["md_ref_first_container"](spark, DATA)._jdf.queryExecution()
    assert "Join" not in plan.executedPlan().toString()
    assert markdown_is_dealt(spark)


def test_md_depth_path_moves_no_lines(spark):
    """documents are dealt to all cores before texts are made, and nothing is shuffled or joined after."""
    plan = planned(spark, "md_depth_path")
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_md_content_range_join_joins_nothing(spark):
    """documents are dealt to all cores before texts are made, and containers are found by windows."""
    plan = registry.queries()["md_content_range_join"](spark, DATA)._jdf.queryExecution()
    assert "Join" not in plan.executedPlan().toString()
    assert markdown_is_dealt(spark)


def test_md_first_child_moves_no_lines(spark):
    """documents are dealt to all cores before texts are made, and nothing is shuffled or joined after."""
    plan = planned(spark, "md_first_child")
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_md_siblings_moves_no_lines(spark):
    """documents are dealt to all cores before texts are made, and nothing is shuffled or joined after."""
    plan = planned(spark, "md_siblings")
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_md_slugs_moves_no_lines(spark):
    """documents are dealt to all cores before texts are made, and nothing is shuffled or joined after."""
    plan = planned(spark, "md_slugs")
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_md_paragraphs_moves_no_lines(spark):
    """documents are dealt to all cores before texts are made, and nothing is shuffled or joined after."""
    plan = planned(spark, "md_paragraphs")
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_noise_is_found_once_a_text(spark):
    """the lines of a text were sorted and counted anew for each of its lines."""
    text = spark.range(1).select(cleaning.without_noise(F.concat(F.lit("a"), F.col("id").cast("string"))).alias("text"))
    assert text._jdf.queryExecution().analyzed().toString().count("array_sort") == 1


def test_cleaned(spark):
    table = "| A | B |\n|---|---|\n| 1 | One ..... 3 |\n| 1.1 | Two ..... 4 |\n| | Three ...... 9 |\n| x | y |\n"
    text = "## 1.2 Deep\nACME\n" + table + "ACME \n<!-- image -->\n7\n ACME\na line\ngoes on.\n| A | B |\n|---|---|\n| 1 | 2 |\nEnd"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    assert rows_of(cleaning.cleaned(docs)) == [(1, "## 1.2 Deep\n- **1** One -- p.3\n - **1.1** Two -- p.4\n- Three -- p.9\n- x\n*[Figure 1: diagram or image -- not extracted]*\n a line goes on.\n| A | B |\n|---|---|\n| 1 | 2 |\nEnd"), (2, None), (3, "")]


def test_dirty_texts_are_dealt(spark):
    """F13"""
    assert planned(spark, "clean_without_noise").count("Exchange ") == 1


def test_noise_of_a_long_text(spark):
    """1,500 lines took a sort of all for each of them."""
    lines = [f"line {k}" for k in range(1500)] + [" twice", "twice", "thrice", " thrice ", "thrice", "w" * 120] + ["w" * 120] * 3
    docs = spark.createDataFrame([("\n".join(lines),)], "text string")
    assert docs.select(cleaning.without_noise(F.col("text"))).first()[0].split("\n") == [x for x in lines if "thrice" not in x]


def test_yaml_is_parsed_by_all_cores(spark):
    """files were parsed by as many tasks as their scan had splits."""
    for name in ("res_yaml_flatten", "res_xml"):
        plan = planned(spark, name)
        assert plan.index("ArrowEvalPython") < plan.index("Exchange ")


def test_specifications_are_dealt(spark):
    """texts were read by as many tasks as the scan had splits."""
    assert planned(spark, "md_spec_meta").count("Exchange ") == 1


def test_edges_of_a_name_are_not_sorted(spark):
    """edges were sorted by name to be joined, and those of one name lie in one task."""
    plan = planned(spark, "rel_normalise")
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def test_names_are_summed_up_before_they_are_looked_up(spark):
    """an edge met every type of its target's name, so the work grew with the square of a name's holders."""
    assert "min_by" not in planned(spark, "java_injects_resolution")


def test_resolve_names(spark):
    types = [("b", "p", "X"), ("a", "q", "X"), ("c", "p", "X"), ("d", "q", "Y")]
    found = spark.createDataFrame([(p, q, n, f"{q}.{n}", f"m{p}") for p, q, n in types], "path string, package string, name string, full_name string, module string")
    edges = spark.createDataFrame([("e", "p", "X"), ("e", "p", "X"), ("e", "r", "X"), ("e", None, "X"), ("e", "p", "Y"), ("e", "p", "Z"), ("e", "p", "a.B")], "path string, package string, target string")
    near = [("e", None, "X", "q.X", "ma"), ("e", "p", "X", "p.X", "mb"), ("e", "p", "Y", "q.Y", "md"), ("e", "p", "Z", "Z", None), ("e", "p", "a.B", "a.B", None), ("e", "r", "X", "q.X", "ma")]
    assert rows_of(java.resolve_names(edges, found)) == sorted(near, key=repr)
    first = [(*r[:3], *("q.X", "ma")) if r[2] == "X" else r for r in near]
    assert rows_of(java.resolve_names(edges, found, False)) == sorted(first, key=repr)


def test_types_of_a_name_meet_no_edges(spark):
    """the types of a name and the edges to it met in one task, whose memory grew with both."""
    plan = planned(spark, "java_name_resolution")
    assert "min_by" not in plan and "SortMergeJoin" not in plan


def test_annotations_read_types_once(spark):
    """F16: each kind of edge parsed all types anew for each kind of thing that has annotations."""
    assert planned(spark, "java_annotation_edges").count("Scan ExistingRDD") <= 3


def parted(n, links):
    at = list(range(n))
    for a, b in links:
        old, new = max(at[a], at[b]), min(at[a], at[b])
        at = [new if x == old else x for x in at]
    return at


@pytest.mark.parametrize(("size", "threshold", "n"), [(3, 0.97, 300), (8, 0.7, 200), (2, 0.9999, 300), (5, 0.1, 150), (20, 0.9, 100)])
def test_forest_of_two_parts(size, threshold, n):
    """the forest of two parts, tile by tile, has the components of all links between them, and no more edges than it needs."""
    deal = np.random.default_rng(size)
    x = deal.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near, every = x @ x.T >= threshold, np.arange(n)
    first = np.flatnonzero(deal.random(n) < 0.5)
    for a, b in ((every, every), (first, np.setdiff1d(every, first))):
        links = [(u, v) for u in a for v in b if u != v and near[u, v]]
        got = [(u, v) for u, v, _ in entities._pair_forest(x, a, b, threshold, 37)]
        assert parted(n, got) == parted(n, links) and len(got) < n and all(near[u, v] for u, v in got)


def test_vectors_are_copied_as_often_whatever_their_number(spark):
    """copies were as many as blocks of 1,024, so what was shuffled grew with the square of the vectors."""
    rows = [(k, np.random.default_rng(k).normal(size=4).tolist()) for k in range(120)]
    plan = entities.cosine_links(spark.createDataFrame(rows, "id long, embedding array<double>"), block=2)._jdf.queryExecution().analyzed().toString()
    assert f"sequence(0, {entities.PARTS - 1}" in plan
