"""The whole way from files to a graph, and its replaceable parts."""

import pytest

from graphloom.plans import stages

JAVA = [("r", "m", "src/A.java", "package p; import java.util.List; class OrderService extends BaseService { }"), ("r", "m", "src/B.java", "package p; class BaseService { }")]
MARKDOWN = [(1, "# Order Service\n\n## Payment Consent\n\ntext of the account\n")]
SPEC = [("s", '{"openapi": "3.0.0", "info": {"title": "T", "version": "1"}, "paths": {"/orders": {"get": {"responses": {"200": {"description": "ok"}}}}}, "components": {"schemas": {"Order": {"type": "object"}}}}')]


def inputs(spark):
    return {
        "java": spark.createDataFrame(JAVA, "repository string, module string, path string, text string"), "markdown": spark.createDataFrame(MARKDOWN, "doc_id long, text string"),
        "openapi": spark.createDataFrame(SPEC, "spec string, text string"), "documents": spark.createDataFrame([(1, "the account of the payer")], "doc_id long, text string"),
    }


def test_from_files_to_graph(spark):
    written = []
    run = stages.run({**inputs(spark), "writer": lambda nodes, edges: written.append((nodes.count(), edges.count()))})
    assert [(s.name, s.status) for s in run.stages] == [("parse", "completed"), ("extract", "completed"), ("embed", "completed"), ("graph", "completed")], run.stages
    graph = run.state["graph"]
    kinds = {r.source_parser for r in run.state["entities"].select("source_parser").distinct().collect()}
    assert {"java_parser", "markdown_parser", "openapi_parser"} <= kinds
    assert written == [(graph.nodes.count(), graph.edges.count())] and written[0][0] >= 4 and written[0][1] >= 2
    assert all(len(r.embedding) == 64 for r in run.state["entities"].collect())
    assert run.status == "completed"


def test_a_failure_is_recorded(spark):
    def broken(state):
        raise RuntimeError("no model")

    run = stages.run(inputs(spark), {**stages.STAGES, "embed": broken})
    assert [(s.name, s.status) for s in run.stages] == [("parse", "completed"), ("extract", "completed"), ("embed", "failed"), ("graph", "skipped")]
    assert run.stages[2].error == "RuntimeError: no model" and run.status == "failed" and "entities" in run.state
    assert stages.run({}).stages[0].status == "failed"


def test_settings_and_registry():
    assert stages.setting({"a": {"b": 3}}, "a.b") == 3 and stages.setting({"a": 1}, "a.b", 7) == 7
    registry = stages.Registry()
    registry.register("embedder", "hashed", lambda size=2: size)
    assert registry.make("embedder", "hashed", size=5) == 5 and registry.names("embedder") == ["hashed"]
    with pytest.raises(KeyError):
        registry.make("embedder", "other")
