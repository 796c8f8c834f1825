"""op1 and op8: exact removal of repeats, against brute force."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from graphloom.llm import difference_cover, packed  # noqa: E402
from graphloom.llm.packed import remove_repeats  # noqa: E402
from graphloom.llm.substring_dedup import rank_words, substring_dedup, window_names  # noqa: E402
from graphloom.llm.suffix_dedup import rank_bytes, suffix_array, suffix_dedup  # noqa: E402


def rows(seed, letters="ab"):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(letters, k=rng.randint(1, 3)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(4)]
    out = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), " ".join(word() for _ in range(rng.randint(0, 8)))]
        out.append((i * 3, rng.choice([" ", "\n", " \t "]).join(parts)))
    out += [(1000, out[5][1]), (1001, out[5][1]), (1002, None), (1003, ""), (1004, " \n "), (1005, "é" * 40), (1006, "x é" * 40), (1007, "x é" * 41)]
    out.append((1008, " ".join(out[k][1] or "" for k in range(60))))
    return out


@pytest.mark.parametrize("words", [True, False])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_against_brute_force(spark, words, letters):
    data = rows(len(letters), letters)
    random.Random(1).shuffle(data)
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = (substring_dedup if words else suffix_dedup)(docs)
    got = got.select("doc_id", "n_units", "n_removed", "n_spans", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert sorted(map(tuple, got)) == brute.repeats(data, 13 if words else 50, words)


@pytest.mark.parametrize("words", [True, False])
def test_small_groups_and_sketch(spark, words, monkeypatch):
    """Many groups, counters that all share, super-k-mers that are cut: results stay."""
    data = rows(7, "abcdefgh") + [(2000 + k, "ha " * (40 + 30 * k)) for k in range(5)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    rank = rank_words(13) if words else rank_bytes(50)
    got = remove_repeats(docs, width=13 if words else 50, words=words, rank=rank, group=300, bits=6)
    got = got.select("doc_id", "n_units", "n_removed", "n_spans", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert sorted(map(tuple, got)) == brute.repeats(data, 13 if words else 50, words)


def pieces_of(texts, classes, width=13):
    ids = np.arange(len(texts))
    return list(packed._pieces(ids, [t.encode() for t in texts], width, packed.word_units, classes))


def test_common_line_has_no_hot_minimiser():
    """A line that all documents share, between words of their own: strings that differ do not meet in one bucket."""
    rng = random.Random(5)
    own = lambda: " ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(30))
    line = " ".join(f"line{k}" for k in range(14))
    texts = [f"{own()} {line} {own()}" for _ in range(400)]
    units = packed.word_units([t.encode() for t in texts])
    hashed, _ = packed.gram_hashes(units[0], units[-1], 13)
    count = np.bincount((hashed >> np.uint64(44)).astype(np.int64), minlength=1 << 20)
    classes = np.frexp(count.astype(float))[1].astype(np.uint8)
    for given, bound in ((classes, 3), (np.zeros(1 << 20, np.uint8), None)):
        strings = {}
        for text, doc, at, n, low, a, b in pieces_of(texts, given):
            for m, x, y in zip(low.tolist(), a.tolist(), b.tolist()):
                strings.setdefault(m, set()).add(text[x:y])
        most = max(map(len, strings.values()))
        assert most <= bound if bound else most > 100


def test_long_super_kmers_are_cut(monkeypatch):
    monkeypatch.setattr(packed, "LONGEST", 10)
    (text, doc, at, n, low, a, b), = pieces_of(["ha " * 60, "x " * 12, "ha " * 33], np.zeros(1 << 20, np.uint8))
    assert n.tolist() == [10, 10, 10, 10, 8, 10, 10, 1] and at.tolist() == [0, 10, 20, 30, 40, 0, 10, 20]
    assert doc.tolist() == [0] * 5 + [2] * 3
    assert {text[x:y].split().count(b"ha") for x, y in zip(a.tolist(), b.tolist())} == {22, 20, 13}


def test_long_text(spark):
    """A text longer than a chunk of the reader, and its copy."""
    rng = random.Random(9)
    body = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(1_100_000))
    docs = spark.createDataFrame([(1, body), (2, body[100:]), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed / max(1, r.n_units) for r in substring_dedup(docs).collect()}
    assert got == {1: 0, 2: 1, 3: 0} or (got[1] == got[3] == 0 and got[2] > 0.99999)


@pytest.mark.parametrize("f", [substring_dedup, suffix_dedup])
def test_edge_rows(spark, f):
    long = " ".join(f"w{k}" for k in range(40))
    data = [(1, long, "a", 7), (None, long, "b", 8), (2, long, None, 9), (2, long, "c", 9), (3, None, "d", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, kept string, __gl_blob int")
    got = {(r.doc_id, r.text): r for r in f(docs).collect()}
    assert len(f(docs).collect()) == 5
    assert got[1, long].n_removed == 0 and got[None, long].n_removed == 0
    assert got[2, long].n_removed == got[2, long].n_units > 0
    assert got[3, None].n_units == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert f(empty).collect() == []


def test_suffix_array():
    rng = np.random.default_rng(2)
    for _ in range(200):
        s = rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 90)))
        assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    wide = rng.integers(1, 1 << 40, 60)
    wide = np.concatenate([wide, wide, wide[:7]])
    assert suffix_array(wide).tolist() == sorted(range(len(wide)), key=lambda i: wide[i:].tolist())


def test_window_names():
    s = np.random.default_rng(3).integers(0, 2, 400)
    names = window_names(s, 13)
    groups = {}
    for k in range(len(names)):
        assert groups.setdefault(tuple(s[k : k + 13].tolist()), names[k]) == names[k]
    assert len(set(names.tolist())) == len(groups)


def ranked(spark, s):
    rows = spark.createDataFrame(list(enumerate(s)), "i long, c long")
    return [r.i for r in difference_cover.suffix_ranks(rows, len(s)).orderBy("rank").collect()]


def test_distributed_difference_cover(spark, monkeypatch):
    """Suffix ranks of short strings with repeats, of all lengths modulo three, over many blocks."""
    monkeypatch.setattr(difference_cover, "BLOCK", 7)
    for own in ([1, 2, 1, 1, 2, 1, 1, 2, 2, 1], [2, 2, 1, 2, 2, 1, 2, 2], [3, 1, 2, 3, 1, 2, 3, 1, 2]):
        assert ranked(spark, own) == sorted(range(len(own)), key=lambda i: own[i:])


def test_repeats_by_adjacent_suffixes(spark):
    data = [(3, "the cat sat on the mat"), (1, "on the mat sat the cat"), (2, None), (5, "the cat sat on the mat"), (7, "é the cat é")]
    got = {(r.doc_id, r.at) for r in difference_cover.repeated_windows(spark.createDataFrame(data, "doc_id long, text string"), 8).collect()}
    own = {d: (t or "").encode() for d, t in data}
    starts = {d: {t[i : i + 8] for i in range(len(t) - 7)} for d, t in own.items()}
    assert got == {(d, i) for d, t in own.items() for i in range(len(t) - 7) if any(e < d and t[i : i + 8] in starts[e] for e in own)}
