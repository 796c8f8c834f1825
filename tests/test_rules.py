"""Scanners and rules against plain Python on small inputs."""

import random
import uuid
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from graphloom.functions import java, listscan, names, versions
from graphloom.operators import cleaning, entities, extraction, markdown, openapi, resources
from graphloom.operators.components import connected_components


def test_uuid5(spark):
    rows = spark.createDataFrame([("a",), ("",), ("é x",)], "n string")
    for r in rows.select("n", names.uuid5(F.col("n")).alias("u")).collect():
        assert r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, r.n))


def test_names(spark):
    cases = [("paymentInitiation", "PaymentInitiation"), ("PaymentAPIController", "PaymentApiController"), ("PAYMENT_INITIATION", "PaymentInitiation"), ("a/b|c", "ABC"), ("  ", "")]
    rows = spark.createDataFrame(cases, "n string, want string")
    assert all(r.got == r.want for r in rows.select("want", names.pascal_case(F.col("n")).alias("got")).collect())
    raw = [(1, "PaymentController", "class", "java_parser"), (2, "GET /accounts/{id}", "endpoint", "openapi_parser"), (3, " ", "x", "y"), (4, None, "x", "y"), (5, "GET /v1/statuses", None, "openapi")]
    got = {r.pos: (r.canonical_id, r.canonical_type) for r in entities.canonicalise(spark.createDataFrame(raw, "pos int, name string, type string, source_parser string")).collect()}
    assert got == {1: ("PaymentInitiation", "domain_entity"), 2: ("AccountInformation", "api_operation"), 5: ("Status", "concept")}


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7), (2000, 2000)] + [(5000, k) for k in range(5001, 5300)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_similar_names_loses_no_pair(spark):
    rng = random.Random(9)
    base = ["".join(rng.choices("abcde", k=rng.randint(4, 14))) for _ in range(40)]
    more = [b[:k] + rng.choice("abcde") + b[k + rng.randint(0, 1) :] for b in base for k in (1, len(b) - 2)]
    listed = sorted(set(base + more))
    rows = spark.createDataFrame([(n, []) for n in listed], "id string, aliases array<string>")
    got = {(r.left, r.right) for r in entities.similar_names(rows).collect()}
    want = {(a, b) for a in listed for b in listed if a < b and SequenceMatcher(None, a, b).ratio() >= 0.88}
    assert got == want and want


def test_lists():
    text = "- a\n  - b\n\n    - c\n- d\n\n1. x\ntext\n* [x] y\n  deep"
    assert listscan.scan(text) == [
        {"start": 1, "end": 7, "kind": "unordered", "n_items": 3, "n_total": 5, "preview": "a|d|x", "first_number": None},
        {"start": 9, "end": 9, "kind": "unordered", "n_items": 1, "n_total": 1, "preview": "y", "first_number": None},
    ]
    assert listscan.scan(None) == [] and listscan.scan("") == []


def test_java_reader():
    made = java.read('package a; import b.C; // class X {\n@Q("}") class D<T> extends E<T> { String s = "{"; void f(int... x) { g().h(new K<>(1)); } class In { void no() {} } }')
    (t,) = made["types"]
    assert (t["name"], t["extends"], [m["name"] for m in t["methods"]], [f["name"] for f in t["fields"]]) == ("D", ["E<T>"], ["f"], ["s"])
    assert [(c["target_class"], c["target_method"]) for c in t["methods"][0]["calls"]] == [(None, "g"), ("g()", "h"), ("K", "<init>")]
    for broken in (None, "", "class", "class A {", "@", "class A { void f( }", "import", "}{", 'class A { String s = "', "enum E { A, B }"):
        java.read(broken)


def test_dereference():
    spec = {"a": {"$ref": "#/c/x"}, "b": {"$ref": "other.yml"}, "d": [{"$ref": "#/gone"}], "c": {"x": {"k": {"$ref": "#/c/y"}}, "y": {"back": {"$ref": "#/c/x"}}}}
    made = openapi.inline(spec)
    assert made["a"] == {"k": {"back": {"$ref": "#/c/x", "ref_cycle_detected": True}}}
    assert made["b"] == {"$ref": "other.yml", "ref_type": "external"} and made["d"] == [{"$ref": "#/gone", "ref_resolved": False}]


def test_flatten():
    assert resources.flatten({"a": {"b": [1, {"c": None}]}, "d": {}}) == {"a.b.0": 1, "a.b.1.c": None, "d": {}}


def test_broken_xml_is_passed_over(spark):
    rows = spark.createDataFrame([("r", "pom.xml", "<project"), ("r", "a/pom.xml", None), ("r", "b/pom.xml", "<project xmlns='u'><artifactId>x</artifactId></project>")], "repository string, path string, text string")
    assert [r.artifact_id for r in resources.maven(rows).collect()] == ["x"]


def test_embedding_failures_keep_rows(spark):
    def client(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no")
        return [[1.0]] * (len(texts) - ("short" in texts))

    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, text string").coalesce(1)
    assert [r.vector for r in extraction.embed(rows, client).collect()] == [[1.0], [1.0]]
    assert [r.vector for r in extraction.embed(spark.createDataFrame([(1, "bad")], "k int, text string"), client).collect()] == [[]]
    assert sorted(len(r.vector) for r in extraction.embed(spark.createDataFrame([(1, "a"), (2, "short")], "k int, text string").coalesce(1), client).collect()) == [0, 1]


def test_lines_and_tables(spark):
    text = "# A\r\nx\x0by\n\n| h | i |\n|---|:-:|\n| 1 |\nend\n"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string")
    ls = markdown.lines(docs).where("doc_id = 1").orderBy("line").collect()
    assert [r.raw for r in ls] == text.splitlines()
    (t,) = markdown.tables(markdown.lines(docs)).collect()
    assert (t.start, t.end, t.headers, t.alignment, t.n_rows) == (5, 7, ["h", "i"], ["left", "center"], 1)


def test_cleaning_in_order(spark):
    text = "ACME\n# 1.2 Head\nACME\nA line\ngoes on\n\n\n\n12\nACME\nEnd."
    (r,) = cleaning.cleaned(spark.createDataFrame([(text,)], "text string")).collect()
    assert r.text == "## 1.2 Head\nA line goes on\n\nEnd."


def test_versions(spark):
    cases = [("PSD2 v1.3.16", "v1.3.16"), ("NextGenPSD2 1.3", "v1.3"), ("Berlin Group V2", "v2"), ("nothing", None), (None, None)]
    rows = spark.createDataFrame(cases, "t string, want string")
    for r in rows.select("want", versions.content_version(F.col("t")).alias("v")).collect():
        assert (r.v.version if r.v else None) == r.want
