"""Scans, sinks and incremental runs in a temporary folder."""

import json

import pytest
from pyspark.sql import functions as F

from graphloom.plans import pipeline
from graphloom.sources import files, sinks
from graphloom.streaming import incremental


def test_scans(spark, tmp_path):
    (tmp_path / "r1" / "sub").mkdir(parents=True)
    (tmp_path / "r1" / "A.java").write_bytes(b"class A { } // \xff")
    (tmp_path / "r1" / "sub" / "s.yml").write_text("openapi: 3.0.0\ninfo: {title: T, version: '1'}\n")
    (tmp_path / "r1" / "bad.yaml").write_text("a: [")
    (tmp_path / "x_clean.md").write_text("# X")
    root = str(tmp_path)
    (d,) = files.documents(spark, root, "java_parser", ("*.java",)).collect()
    assert (d.document_id, d.text) == ("java_parser:r1/A.java", "class A { } // �")
    assert [r.stem for r in files.markdown_documents(spark, root).collect()] == ["x"]
    assert [(r.spec, json.loads(r.text)["info"]["title"]) for r in files.specifications(spark, root).collect()] == [("r1/sub/s.yml", "T")]
    assert {(r.repository, r.path) for r in files.java_files(spark, root).where("path LIKE '%.java'").collect()} == {("r1", "A.java")}


def test_bundles_and_records(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.json").write_text(json.dumps({"documents": [{"document_id": "d", "text": "t", "source_parser": "openapi_parser"}], "chunks": 1}, indent=1))
    (tmp_path / "b" / "broken.json").write_text("{")
    found = files.bundles(spark, str(tmp_path / "b"))
    (d,) = files.bundle_documents(found).collect()
    assert (d.document_id, d.source_type) == ("d", "api") and found.first().entities == []
    (tmp_path / "r").mkdir()
    record = {"source_id": "s", "source_parser": "p", "spacy_entities": [{"label": "L", "text": "x"}], "llm_entities": [{"type": "T", "name": "n"}], "triples": [{"subject": "x", "predicate": "uses", "object": "n", "confidence": 2}], "document_chunks": [{"text": " ", "label": "a"}, {"text": "c", "label": "b"}]}
    (tmp_path / "r" / "a.jsonl").write_text(json.dumps(record) + "\nnot json\n")
    (tmp_path / "r" / "embedded_extraction_1.jsonl").write_text(json.dumps(record) + "\n")
    rows = files.records(spark, str(tmp_path / "r"))
    assert [(r.type, r.name) for r in files.record_entities(rows).orderBy("pos").collect()] == [("L", "x"), ("T", "n")]
    assert [(r.source, r.target, r.relation, r.confidence) for r in files.record_edges(rows).collect()] == [("x", "n", "uses", 1.0)]
    assert [r.text for r in files.record_chunks(rows).collect()] == ["c"]


def test_configuration(spark):
    raw = json.dumps([{"name": "a", "url": "u"}, {"name": "b", "url": "v", "enabled": False}])
    assert [r.name for r in files.configured(spark, raw, ("name", "url")).collect()] == ["a"]
    with pytest.raises(Exception, match="missing field url"):
        files.configured(spark, '[{"name": "a"}]', ("name", "url")).collect()


def test_graph_store(spark, tmp_path):
    path = str(tmp_path / "g")
    nodes = spark.createDataFrame([("a", "T", None), ("b", "T", "x")], "id string, type string, note string")
    edges = spark.createDataFrame([("e1", "a", "b"), ("e2", "a", "gone")], "id string, source string, target string")
    assert sinks.write_graph(spark, path, nodes, edges, "v1") == {"requested_edges": 2, "nodes": 2, "edges": 1}
    more = spark.createDataFrame([("b", "U", None), ("gone", "T", None)], "id string, type string, note string")
    assert sinks.write_graph(spark, path, more, edges, "v2") == {"requested_edges": 2, "nodes": 3, "edges": 2}
    b = spark.read.parquet(f"{path}/v2/nodes").where("id = 'b'").first()
    assert (b.type, b.note) == ("U", "x")
    with pytest.raises(ValueError, match="more than one node"):
        sinks.write_graph(spark, path, nodes.union(nodes), edges, "v3")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a/b", "m 1", 1), ("a/b", "m2", 2)], "repository string, module string, v int")
    sinks.write_bundles(rows, str(tmp_path / "o"), ("repository", "module"))
    assert sorted(p.parent.name for p in (tmp_path / "o").rglob("*.json")) == ["module=m2", "module=m_1"]
    records = spark.createDataFrame([("s", "failed", [1.0]), ("t", "success", [1.0, 2.0])], "source_id string, llm_status string, vector array<double>")
    sinks.append_records(records, str(tmp_path / "x"), keep_failed=False, vectors=False)
    (r,) = spark.read.json(str(tmp_path / "x")).collect()
    assert (r.source_id, r.dimension) == ("t", 2) and "vector" not in r.asDict()
    source = "repository string, module string, document string, file_path string, version_tag string, source_parser string"
    e = spark.createDataFrame([("i", "T", ["x"], 1.0, [("r", None, " ", "f", "v", "p"), ("q", None, None, "f", "v", "p")])], f"id string, type string, aliases array<string>, confidence double, sources array<struct<{source.replace(' string', ':string')}>>")
    (p,) = sinks.store_properties(e).collect()
    assert (p.repository, p.module, p.document, p.file_path) == (["q", "r"], [], [], ["f"])
    seen = []
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    sinks.write_changed(spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, t string"), old, "k", lambda df: seen.extend(sorted(r.k for r in df.collect())))
    assert seen == [2, 3]


def test_artefacts(spark, tmp_path):
    raw = spark.createDataFrame([(1, "PaymentDTO", "class", "x", 0.5), (2, "payment_dto", "class", "x", 1.0), (3, "Other Thing", "field", "x", 1.0)], "pos int, name string, type string, source_parser string, confidence double")
    edges = spark.createDataFrame([(1, "PaymentDTO", "other thing", "calls", 0.5), (2, "payment_dto", "Other Thing", "USES", 0.9)], "pos int, source string, target string, relation string, confidence double")
    g = pipeline.build(raw, edges)
    (e,) = g.edges.collect()
    assert (e.source, e.target, e.type, e.original_types, e.n_provenance) == ("PaymentDto", "OtherThing", "USES", ["USES", "calls"], 2)
    sinks.write_artefacts(str(tmp_path / "a"), g.canonical, g.nodes, g.edges, g.statistics, g.statistics, g.statistics)
    assert len(list((tmp_path / "a").iterdir())) == 6


def test_incremental(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seen = []

    def batch(df, _):
        seen.append(sorted(r.text for r in df.collect()))

    for k in range(2):
        (tmp_path / "in" / f"{k}.md").write_text(f"t{k}")
        incremental.run_available(incremental.new_text_files(spark, str(tmp_path / "in"), "*.md"), str(tmp_path / "cp"), batch)
    assert [x for x in seen if x] == [["t0"], ["t1"]]


def test_distinct_stream(spark, tmp_path):
    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema
    stream = incremental.distinct_within(incremental.event_stream(spark, "/root/testdata/sf0.001", schema), ["user_id", "event_type"], "ts", "10 minutes")
    q = stream.select("user_id", "event_type").writeStream.format("memory").queryName("distinct_events").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination()
    want = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_type").distinct().count()
    assert spark.table("distinct_events").select(F.count("*")).first()[0] >= want


def test_links_by_vectors_and_similar_names(spark):
    rows = [("AlphaThing", [1.0, 0.0]), ("Zulu", [0.0, 1.0]), ("Middle", [0.99, 0.05]), ("Bare", None), ("Nil", [0.0, 0.0]), ("CustomerAddressRecord", None), ("CustomerAddressRecords2", None)]
    raw = spark.createDataFrame([(n, "Class", "markdown_parser", 1.0, k, v) for k, (n, v) in enumerate(rows)], "name string, type string, source_parser string, confidence double, pos long, embedding array<double>")
    edges = spark.createDataFrame([], "source string, target string, relation string, confidence double, pos long")
    groups = sorted(sorted(r.members) for r in pipeline.build(raw, edges).nodes.collect())
    assert [g for g in groups if len(g) > 1] == [["AlphaThing", "Middle"], ["CustomerAddressRecord", "CustomerAddressRecords2"]]
