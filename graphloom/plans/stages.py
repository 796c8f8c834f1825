"""The way from files to a graph in four stages, each replaceable: parse, extract, embed, graph.

A stage is a function of what the stages before made (a dictionary of tables and settings) that returns what it adds. A
stage that fails is recorded, and those behind it are passed over; what was made so far stays.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import tables
from graphloom.functions.checkpoints import checkpoint
from graphloom.operators import extraction, java, markdown, openapi
from graphloom.plans import pipeline

Stage = Callable[[dict[str, Any]], Mapping[str, Any]]


def setting(config: Mapping[str, Any], path: str, default: Any = None) -> Any:
    """A value by its dotted path; the default where a step is missing."""
    at: Any = config
    for step in path.split("."):
        if not isinstance(at, Mapping) or step not in at:
            return default
        at = at[step]
    return at


class Registry:
    """Components by kind and name, made on demand: embedders, models, writers."""

    def __init__(self) -> None:
        self._makers: dict[tuple[str, str], Callable[..., Any]] = {}

    def register(self, kind: str, name: str, maker: Callable[..., Any]) -> None:
        self._makers[kind, name] = maker

    def names(self, kind: str) -> list[str]:
        return sorted(n for k, n in self._makers if k == kind)

    def make(self, kind: str, name: str, **settings: Any) -> Any:
        if (kind, name) not in self._makers:
            raise KeyError(f"no {kind} named {name}; there are {', '.join(self.names(kind)) or 'none'}")
        return self._makers[kind, name](**settings)


@dataclass
class Recorded:
    name: str
    status: str
    seconds: float = 0.0
    error: str = ""


@dataclass
class Run:
    state: dict[str, Any]
    stages: list[Recorded] = field(default_factory=list)

    @property
    def status(self) -> str:
        return "failed" if any(s.status == "failed" for s in self.stages) else "completed"


def _entities(rows: DataFrame, name: str, kind: str, parser: str) -> DataFrame:
    made = rows.select(F.expr(name).alias("name"), F.expr(kind).alias("type"), F.lit(parser).alias("source_parser"), F.lit(1.0).alias("confidence"))
    return made.withColumn("pos", F.xxhash64("source_parser", "type", "name"))


def _edges(rows: DataFrame, source: str, target: str, relation: str) -> DataFrame:
    made = rows.select(F.expr(source).alias("source"), F.expr(target).alias("target"), F.expr(relation).alias("relation"), F.lit(1.0).alias("confidence"))
    return made.withColumn("pos", F.xxhash64("source", "target", "relation"))


def parse(state: dict[str, Any]) -> Mapping[str, Any]:
    """Entities and edges of what there is of ``java`` (repository, module, path, text), ``markdown`` (doc_id, text) and
    ``openapi`` (spec, text), and all texts as ``documents``."""
    entities: list[DataFrame] = []
    edges: list[DataFrame] = []
    if "java" in state:
        parsed = java.parse(state["java"], keep=True)
        found = java.types(parsed)
        entities.append(_entities(found, "full_name", "kind", "java_parser"))
        edges += [_edges(java.resolve_names(java.inheritance(found), found), "source", "full_target", "type"), _edges(java.import_edges(found, java.imports(parsed)), "source", "target", "'IMPORTS'")]
    if "markdown" in state:
        lines = checkpoint(markdown.lines(state["markdown"]))
        found = markdown.parents(markdown.sections(lines))
        entities.append(_entities(found, "name", "'section'", "markdown_parser"))
        upper = found.select("doc_id", F.col("start").alias("parent"), F.col("name").alias("above"))
        edges.append(_edges(found.join(upper, ["doc_id", "parent"]), "above", "name", "'CONTAINS'"))
    if "openapi" in state:
        entities.append(_entities(openapi.endpoints(state["openapi"]), "concat_ws(' ', method, path)", "'endpoint'", "openapi_parser"))
        entities.append(_entities(openapi.schemas(state["openapi"]), "name", "'schema'", "openapi_parser"))
    if not entities:
        raise ValueError("nothing to parse")
    union = lambda parts: checkpoint(_all(parts))
    return {"entities": union(entities), "edges": union(edges) if edges else None}


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def extract(state: dict[str, Any]) -> Mapping[str, Any]:
    """Terms of the vocabulary in ``documents`` (doc_id, text), if there are any, beside the parsed entities."""
    if "documents" not in state:
        return {}
    found = extraction.vocabulary_matches(state["documents"], state.get("vocabulary", tables.VOCABULARY), state.get("label", tables.VOCABULARY_LABEL))
    return {"entities": checkpoint(state["entities"].unionByName(_entities(found, "term", "label", "vocabulary")))}


def embed(state: dict[str, Any]) -> Mapping[str, Any]:
    """A vector for each entity, by the client of the state, else by hashed words; one request for all rows of a name."""
    rows = state["entities"]
    texts = rows.select("name", "type").distinct().withColumn("text", extraction.embedding_text(F.col("type"), F.col("name"), F.lit(""), F.lit("")))
    made = extraction.embed(texts, state.get("embedder", extraction.hashed_vectors)).select("name", "type", F.col("vector").alias("embedding"))
    return {"entities": checkpoint(rows.join(made, ["name", "type"]))}


def graph(state: dict[str, Any]) -> Mapping[str, Any]:
    """The canonical graph, handed to the ``writer`` of the state if there is one."""
    edges = state.get("edges")
    if edges is None:
        edges = state["entities"].sparkSession.createDataFrame([], "source string, target string, relation string, confidence double, pos long")
    made = pipeline.build(state["entities"], edges)
    if "writer" in state:
        state["writer"](made.nodes, made.edges)
    return {"graph": made}


STAGES: dict[str, Stage] = {"parse": parse, "extract": extract, "embed": embed, "graph": graph}


def run(inputs: Mapping[str, Any], stages: Mapping[str, Stage] = STAGES) -> Run:
    """All stages in order, over a copy of ``inputs``; the result records what each did."""
    out = Run(dict(inputs))
    for name, stage in stages.items():
        if out.status == "failed":
            out.stages.append(Recorded(name, "skipped"))
            continue
        start = time.monotonic()
        try:
            out.state.update(stage(out.state))
        except Exception as error:  # noqa: BLE001 - whatever it is, it is recorded
            out.stages.append(Recorded(name, "failed", time.monotonic() - start, f"{type(error).__name__}: {error}"))
        else:
            out.stages.append(Recorded(name, "completed", time.monotonic() - start))
    return out
