"""Substring dedup on words: super-k-mer partitioning with exact window counting by sorting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import table
from graphloom.llm.packed import remove_repeats, word_numbers

WIDTH = 13


def window_names(numbers: np.ndarray, width: int) -> np.ndarray:
    """The same name for equal windows and no others: names of 1, 2, 4, ... units are paired and sorted."""
    names, have = numbers, 1
    while have < width:
        step = min(have, width - have)
        names = np.unique(names[: len(names) - step] * (int(names.max(initial=0)) + 1) + names[step:], return_inverse=True)[1]
        have += step
    return names


def rank_words(width: int):
    def rank(strings: list[bytes], docs: np.ndarray) -> np.ndarray:
        """For each window, string after string, the first document that has it."""
        words: list[bytes] = []
        counts = np.zeros(len(strings), np.int64)
        for k, s in enumerate(strings):
            own = s.split(b" ")
            counts[k] = len(own)
            words += own
        names = window_names(word_numbers(words)[0], width)
        of = np.repeat(np.arange(len(strings)), counts)
        inside = np.flatnonzero(of[: len(names)] == of[width - 1 :])
        least = np.full(int(names.max(initial=0)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, names[inside], docs[of[inside]])
        return least[names[inside]]

    return rank


def substring_dedup(docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove words covered by a window of ``width`` words that also starts in a document with a smaller key.

    Adds ``kept`` (words left, joined by one space), ``n_units``, ``n_removed`` and ``n_spans``; see
    :func:`graphloom.llm.packed.remove_repeats` for nulls, repeated keys and clashing columns. A text shorter than
    the window is kept whole; an empty table gives an empty result.
    """
    return remove_repeats(docs, width=width, words=True, rank=rank_words(width), key=key, text=text)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "n_spans")


ORACLE = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS s FROM w WHERE len(ws) >= 13
), firsts AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s
), hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM win JOIN firsts USING (s) WHERE firsts.d < win.doc_id
), gone AS (SELECT doc_id, list(k ORDER BY k) AS ks FROM hit GROUP BY doc_id
), runs AS (SELECT doc_id, count(*) AS n_spans FROM (SELECT doc_id, k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM hit) WHERE g IS NULL OR g > 1 GROUP BY doc_id
), words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS k, unnest(ws) AS word FROM w
), kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN hit ON words.doc_id = hit.doc_id AND words.k = hit.k GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES = {"op1_substring_dedup": op1_substring_dedup}
ORACLES = {"op1_substring_dedup": ORACLE}
