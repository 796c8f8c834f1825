"""Entities, versions, triples and vectors out of texts; answers of models as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions import tables
from graphloom.functions.names import clamp_confidence, lookup, strip
from graphloom.operators.entities import first_per

WORD = r"[\p{L}\p{N}_]+"
#: Texts a request, characters of a text, tries of a request, and length of the vectors of the built-in embedder.
BATCH, LONGEST, TRIES, DIMENSION = 32, 100_000, 3, 64


def vocabulary_matches(docs: DataFrame, vocabulary: dict[str, list[str]] = tables.VOCABULARY, label: str = tables.VOCABULARY_LABEL) -> DataFrame:
    """Words that are terms or their other forms, in any case; each (label, lower case) of a text once, as first written.

    The vocabulary is a dimension table of a few rows and is joined by broadcast.
    """
    forms = [(a.lower(), term, label) for term, others in vocabulary.items() for a in {term, *others} if len(a.split()) == 1]
    known = docs.sparkSession.createDataFrame(sorted(set(forms)), "form string, term string, label string")
    words = docs.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))).alias("pos", "word")).withColumn("form", F.lower("word"))
    found = words.join(F.broadcast(known), "form")
    return found.groupBy("doc_id", "label", "form").agg(F.min_by("word", "pos").alias("name"), F.min("pos").alias("pos"), F.count("*").alias("n"), F.min("term").alias("term"))


def answers(raw: DataFrame, column: str = "answer") -> DataFrame:
    """Model answers, bare or in a code fence, as ``entities`` and ``relationships``; ``error`` says what is wrong."""
    fenced = F.regexp_extract(column, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = strip(F.when(fenced != "", fenced).otherwise(F.col(column)))
    shape = "struct<entities:array<struct<type:string,name:string,label:string,properties:map<string,string>>>,relationships:array<struct<source:string,target:string,type:string,confidence:double>>>"
    good = F.try_parse_json(body).isNotNull() & body.startswith("{")
    return raw.withColumn("__gl_body", body).withColumn("error", F.when(body == "", "empty").when(~F.coalesce(good, F.lit(False)), "not a JSON object")).withColumn("a", F.when(F.col("error").isNull(), F.from_json("__gl_body", shape))).drop("__gl_body")


def answer_entities(parsed: DataFrame) -> DataFrame:
    """Named entities, defaults filled in."""
    e = parsed.select("source_id", F.posexplode("a.entities").alias("pos", "e")).withColumn("name", strip(F.coalesce("e.name", F.lit("")))).where("name <> ''")
    return e.select("source_id", "pos", "name", F.coalesce(F.nullif("e.type", F.lit("")), F.lit("entity")).alias("type"), F.coalesce(F.nullif("e.label", F.lit("")), F.lit("UNKNOWN")).alias("label"))


def answer_relationships(parsed: DataFrame, found: DataFrame) -> DataFrame:
    """Relationships between named entities of the same answer: the last one of a name, in any case, is meant."""
    index = found.groupBy("source_id", F.lower("name").alias("key")).agg(F.max_by("name", "pos").alias("name"))
    r = parsed.select("source_id", F.posexplode("a.relationships").alias("pos", "r"))
    r = r.select("source_id", "pos", F.lower(strip(F.coalesce("r.source", F.lit("")))).alias("s"), F.lower(strip(F.coalesce("r.target", F.lit("")))).alias("t"), strip(F.coalesce("r.type", F.lit(""))).alias("type"), clamp_confidence(F.col("r.confidence")).alias("confidence")).where("s <> '' AND t <> '' AND type <> ''")
    return r.join(index.select("source_id", F.col("key").alias("s"), F.col("name").alias("source")), ["source_id", "s"]).join(index.select("source_id", F.col("key").alias("t"), F.col("name").alias("target")), ["source_id", "t"]).select("source_id", "pos", "source", "target", "type", "confidence")


def triples(relationships: DataFrame) -> DataFrame:
    """Subject, predicate, object, each triple (in any case) once: the most confident, the first of equals."""
    t = relationships.withColumn("predicate", F.upper("type")).withColumn("s", F.lower("source")).withColumn("o", F.lower("target"))
    return first_per(t, ["source_id", "s", "predicate", "o"], [F.col("confidence").desc(), "pos"]).select("source_id", F.col("source").alias("subject"), "predicate", F.col("target").alias("object"), "confidence")


def first_records(records: DataFrame, limit: int, *order: str) -> DataFrame:
    """The first records in the order of columns; all of them if the limit is 0. The limit is the feature here."""
    return records.orderBy(*order).limit(limit) if limit > 0 else records


def summary(parsed: DataFrame, entities: DataFrame, relationships: DataFrame, merged: DataFrame) -> DataFrame:
    """One row of counters: records, failed ones, entities, relationships, triples."""
    both = parsed.agg(F.count("*").alias("n_records"), F.count("error").alias("n_failed"))
    for name, rows in (("n_entities", entities), ("n_relationships", relationships), ("n_triples", merged)):
        both = both.join(rows.agg(F.count("*").alias(name)), how="cross")  # rows of one each
    return both


def embedding_text(kind: Column, name: Column, description: Column, summary: Column) -> Column:
    """``type: name`` and what there is of a description, cut at the longest text that a model takes."""
    more = F.coalesce(F.nullif(description, F.lit("")), F.nullif(summary, F.lit("")))
    return F.substr(F.concat_ws(" ", F.concat_ws(": ", kind, name), more), F.lit(1), F.lit(LONGEST))


def input_type(kind: Column) -> Column:
    return F.coalesce(lookup(F.lower(kind), tables.INPUT_TYPES), F.lit("ENTITY"))


def is_final_error(message: Column) -> Column:
    """Whether another try can't help."""
    return F.lower(message).rlike("too long|invalid_request_error|400")


def hashed_vectors(texts: list[str]) -> list[list[float]]:
    """Words counted into fixed places by a hash: an embedder that needs no model."""
    import zlib

    out = []
    for text in texts:
        v = np.zeros(DIMENSION)
        for w in text.lower().split():
            h = zlib.crc32(w.encode())
            v[h % DIMENSION] += 1 if h >> 31 else -1
        n = float(np.sqrt((v * v).sum()))
        out.append((v / n if n else v).tolist())
    return out


def embed(rows: DataFrame, client: Callable[[list[str]], list[list[float]]] = hashed_vectors, text: str = "text", batch: int = BATCH, tries: int = TRIES) -> DataFrame:
    """``rows`` with ``vector``: requests of a bounded number of texts, tried again, and an empty vector where all fail."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", vector array<double>"

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors: list = []
            for at in range(0, len(frame), batch):
                texts = frame[text].fillna("").tolist()[at : at + batch]
                for _ in range(tries):
                    try:
                        got = list(client(texts))
                        break
                    except Exception:  # noqa: BLE001  a provider may raise anything; the rows are kept
                        got = []
                vectors += got + [[]] * (len(texts) - len(got))
            yield frame.assign(vector=vectors)

    return rows.mapInPandas(run, schema)


def complete(rows: DataFrame, client: Callable[[str], str], prompt: str = "text", tries: int = TRIES) -> DataFrame:
    """``rows`` with ``answer``; null after the last try, so that one bad text never ends a job."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", answer string"

    def one(text: str) -> str | None:
        for _ in range(tries):
            try:
                return client(text)
            except Exception:  # noqa: BLE001
                continue
        return None

    return rows.mapInPandas(lambda frames: (f.assign(answer=[one(t) for t in f[prompt]]) for f in frames), schema)
