"""Suffix-array dedup on bytes: difference-cover suffix sorting in minimiser buckets, then adjacent prefixes compared."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import U64, table
from graphloom.llm.packed import loads, remove_repeats

WIDTH = 50
#: Below this many different values, three of them fit one unsigned 64-bit number.
_NARROW = 1 << 21


def _triple_names(t: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Names, from 1, of the triples at the sampled places, in the order of the triples."""
    if int(t.max(initial=0)) < _NARROW:
        u = t.astype(U64)
        return np.unique(u[at] << U64(42) | u[at + 1] << U64(21) | u[at + 2], return_inverse=True)[1] + 1
    order = np.lexsort((t[at + 2], t[at + 1], t[at]))
    a = at[order]
    new = np.ones(len(a), bool)
    new[1:] = (t[a[1:]] != t[a[:-1]]) | (t[a[1:] + 1] != t[a[:-1] + 1]) | (t[a[1:] + 2] != t[a[:-1] + 2])
    names = np.empty(len(a), np.int64)
    names[order] = np.cumsum(new)
    return names


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (values from 1 on) in sorted order, by the difference cover {1, 2} modulo 3.

    Suffixes at the sampled places get their order from the names of their triples, if need be by recursion on the
    string of names; the other third is sorted by its first value and the following sampled suffix, and both orders
    are merged by the ranks of sampled suffixes.
    """
    n = len(s)
    if n < 8:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    if int(s.max()) > max(n, 256):
        s = np.unique(s, return_inverse=True)[1] + 1
    t = np.concatenate([s, [0, 0, 0]])
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    names = _triple_names(t, sample)
    if names.max() < len(sample):
        order = suffix_array(names)
        names[order] = np.arange(1, len(order) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    ordered = np.empty(len(sample), np.int64)
    ordered[names - 1] = sample
    ordered = ordered[ordered < n]
    zeros = np.arange(0, n, 3)
    high = n + 2
    zeros = zeros[np.argsort(t[zeros] * high + rank[zeros + 1])]
    first, second = ordered[ordered % 3 == 1], ordered[ordered % 3 == 2]
    before = np.searchsorted(t[first] * high + rank[first + 1], t[zeros] * high + rank[zeros + 1])
    pairs = t[:-1] * (int(t.max()) + 1) + t[1:]
    if int(pairs.max()) > (1 << 62) // high:
        pairs = np.unique(pairs, return_inverse=True)[1]
    before += np.searchsorted(pairs[second] * high + rank[second + 2], pairs[zeros] * high + rank[zeros + 2])
    out = np.full(n, -1, np.int64)
    out[np.arange(len(zeros)) + before] = zeros
    out[out < 0] = ordered
    return out


def equal_prefixes(packed: bytes, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    if width < 8:
        raw = np.frombuffer(packed, np.uint8)
        return np.logical_and.reduce([raw[a + k] == raw[b + k] for k in range(width)])
    eight = loads(packed)
    same = eight[a] == eight[b]
    for k in [*range(8, width - 7, 8), width - 8]:
        same &= eight[a + k] == eight[b + k]
    return same


def rank_bytes(width: int):
    def rank(strings: list[bytes], docs: np.ndarray) -> np.ndarray:
        """For each window, string after string, the first document that has it."""
        packed = b"".join(strings)
        counts = np.fromiter(map(len, strings), np.int64, len(strings))
        of = np.repeat(np.arange(len(strings)), counts)
        inside = np.zeros(len(packed), bool)
        inside[: len(packed) - width + 1] = of[: len(packed) - width + 1] == of[width - 1 :]
        order = suffix_array(np.frombuffer(packed, np.uint8).astype(np.int64) + 1)
        order = order[inside[order]]
        new = np.ones(len(order), bool)
        new[1:] = ~equal_prefixes(packed, order[:-1], order[1:], width)
        head = np.flatnonzero(new)
        least = np.zeros(len(packed), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(docs[of[order]], head), np.diff(np.append(head, len(order))))
        return least[inside]

    return rank


def suffix_dedup(docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove bytes covered by a ``width``-byte string that also starts in a document with a smaller key.

    Adds ``kept`` (binary: a cut may fall inside a character), ``n_units``, ``n_removed`` and ``n_spans``; see
    :func:`graphloom.llm.packed.remove_repeats` for nulls, repeated keys and clashing columns. A text shorter than
    ``width`` bytes is kept whole; an empty table gives an empty result.
    """
    return remove_repeats(docs, width=width, words=False, rank=rank_bytes(width), key=key, text=text)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(docs).select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op8_suffix_dedup": op8_suffix_dedup}
ORACLES: dict[str, str] = {}
