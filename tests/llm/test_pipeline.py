"""Registration, SQL of the queries that have it, and the pipeline against plain versions of its stages."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))
import brute  # noqa: E402
from oracle import DATA, compare  # noqa: E402
from test_operators import plain_fingerprint, plain_groups, plain_infix  # noqa: E402

import corpus_pipeline  # noqa: E402
from graphloom.llm import decontamination, language_id, registry  # noqa: E402

COLUMNS = corpus_pipeline.COLUMNS


def test_names():
    names = sorted(registry.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 11)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "substring_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    compare(spark, registry.queries()[name], registry.oracle_sql()[name], "sf0.001")


def stage(spark, k, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return corpus_pipeline.STAGES[k][1](spark, docs, f"{DATA}/sf0.001")


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select(COLUMNS)
    rows = [tuple(r) for r in docs.collect()]
    told = sorted(map(tuple, stage(spark, 0, rows).collect()))
    assert set(told) <= set(rows) and len(told) > 0.95 * len(rows)
    groups = plain_groups({r[0]: plain_fingerprint(r[1]) for r in rows})
    kept = sorted(map(tuple, stage(spark, 1, rows).collect()))
    assert kept == sorted(r for r in rows if groups[r[0]] == r[0])
    want = {d: (n, gone) for d, n, gone, _, _ in brute.repeats([(r[0], r[1]) for r in rows], 13, True)}
    cut = {r.doc_id: r for r in stage(spark, 2, rows).collect()}
    assert cut.keys() == {d for d, (n, gone) in want.items() if not gone or gone < n}
    for d, text, *_ in rows:
        if d in cut:
            assert len(cut[d].text.split()) == want[d][0] - want[d][1] and (want[d][1] or cut[d].text == text) and (not want[d][1] or cut[d].n_chars == len(cut[d].text))
    items = [decontamination.plain(r.text.encode()) for r in spark.read.parquet(f"{DATA}/sf0.001/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stage(spark, 3, rows).collect()}
    for d, text, *_ in rows[:60]:
        own = decontamination.plain(text.encode())
        leaked = any(i in own for i in items) or len(own) < 600 and any(plain_infix(i, own) <= int(0.1 * len(i)) for i in items)
        assert not leaked or d not in clean
    assert not {d for d, text, *_ in rows if any(i in decontamination.plain(text.encode()) for i in items)} & clean


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f", "x", "s", 1), (1, "a b c d e f", "x", "s", 1), (2, "a b c d e f", None, None, None), (None, "q", None, None, None), (3, "other words stand here now ok", "x", "s", 1)]
    assert sorted((r.doc_id or 0) for r in stage(spark, 1, rows).collect()) == [0, 1, 3]
    for k in range(5):
        assert stage(spark, k, []).collect() == []


def test_rejected_languages_go(spark):
    rows = [(k, "the of and to in is " * 9, "en", "s", 1) for k in range(20)] + [(100 + k, "der die und das ist ein " * 9, "de", "s", 1) for k in range(20)] + [(200, "123 !!", "en", "s", 1), (201, None, "en", "s", 1)]
    assert {r.doc_id for r in stage(spark, 0, rows).collect()} == {r[0] for r in rows if r[0] < 200}
    assert language_id.UNKNOWN == "und"


def test_a_corpus_without_labels_stays(spark):
    rows = [(1, "the of and to in is", None, "s", 1), (2, None, None, None, None), (None, "12", None, "s", 1)]
    assert sorted(map(str, map(tuple, stage(spark, 0, rows).collect()))) == sorted(map(str, rows))


def test_leaks_go_with_any_key(spark):
    item = spark.read.parquet(f"{DATA}/sf0.001/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, f"before {item} after", "en", "s", 1), (None, "clean", "en", "s", 1), (4, "clean too", "en", "s", 1), (4, item, "en", "s", 1), (5, None, None, None, None)]
    assert sorted(map(str, map(tuple, stage(spark, 3, rows).collect()))) == sorted(str(r) for r in rows if item not in (r[1] or ""))


def test_leaks_go_when_their_beginnings_are_other_bytes(spark):
    """The first tenth of an item, which is all that may differ, is something else; the rest is copied."""
    items = sorted((decontamination.plain(r.text.encode()).decode() for r in spark.read.parquet(f"{DATA}/sf0.001/benchmark.parquet").collect()), key=lambda t: (-len(t), t))[:8]
    rows = [(k, "q" * (len(t.encode()) // 10) + t[len(t.encode()) // 10 :], "en", "s", 1) for k, t in enumerate(items) if t.isascii()] + [(100, "clean", "en", "s", 1)]
    assert len(rows) > 3 and [r.doc_id for r in stage(spark, 3, rows).collect()] == [100]


def test_long_documents_keep_their_language(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select(COLUMNS).collect()]
    more = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet").where("text IS NOT NULL")
    for k, lang in enumerate(["de", "en", "es", "fr"]):
        body = "\n".join(r.text for r in more.where(f"lang = '{lang}'").select("text").collect())[: 8 << 20]
        rows.append((10**9 + k, body, lang, "s", len(body)))
        assert len(body) > 2e6
    kept = {r.doc_id for r in stage(spark, 0, rows).select("doc_id").collect()}
    assert {r[0] for r in rows if r[0] >= 10**9} <= kept


def test_run(spark):
    got = corpus_pipeline.run(spark, f"{DATA}/sf0.001")
    assert got.columns[:5] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] and got.count() > 100


def test_run_leaves_the_last_input_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "shared_folder", lambda _: str(tmp_path))
    corpus_pipeline.run(spark, f"{DATA}/sf0.001")
    (base,) = tmp_path.iterdir()
    assert [f.name for f in base.iterdir()] == ["3-decontamination"]
