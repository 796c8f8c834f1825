"""Reproducible sharding: a Feistel permutation, with cycle walking, over global row numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.common import U64, mix64, table

SHARDS, ROUNDS, SEED = 16, 6, 20240229
#: Least number of bins that rows are numbered in, and rows for which there is one; the driver gets their counts only.
BINS, BIN_ROWS = 4096, 250_000
OUTPUTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def feistel(x: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 .. n - 1 that any single value can be put through, either way.

    A balanced Feistel network permutes the smallest even-width binary range that holds n; a value that leaves
    0 .. n - 1 is put through again until it is back (cycle walking), which takes under four steps on average.
    """
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, shift = U64((1 << half) - 1), U64(half)
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
    out = x.astype(U64)
    walking = np.arange(len(out))
    while len(walking):
        v = out[walking]
        left, right = v >> shift, v & mask
        for k in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ (mix64(left + k) & mask), left
            else:
                left, right = right, left ^ (mix64(right + k) & mask)
        v = left << shift | right
        out[walking] = v
        walking = walking[v >= U64(n)]
    return out.astype(np.int64)


def place(rows: np.ndarray, n: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of global row numbers: shards' counts differ by one at most, slots are gapless."""
    at = feistel(rows, n, seed)
    return at % shards, at // shards


def numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """``docs`` with ``__gl_row``, a gapless number from 0 that depends on the rows only, and their count.

    Rows fall into bins, as many as their count demands, by a hash of key and text; a row's number is what the bins before
    hold plus its rank by key, checksum and size inside its bin. Equal rows may change places, which nobody can tell.
    """
    spark = docs.sparkSession
    bins = max(BINS, docs.count() // BIN_ROWS)
    where = F.pmod(F.xxhash64(key, text), F.lit(bins)).cast("int")
    counts = dict(docs.select(where.alias("b")).groupBy("b").count().collect())
    before, total = [], 0
    for b in range(bins):
        before.append((b, total))
        total += counts.get(b, 0)
    offsets = spark.createDataFrame(before, "__gl_bin int, __gl_before long")
    ranked = docs.withColumn("__gl_bin", where).withColumn("text_crc32", F.crc32(F.coalesce(F.col(text), F.lit("")))).withColumn("size", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")).drop(text)
    rank = F.row_number().over(Window.partitionBy("__gl_bin").orderBy(key, "text_crc32", "size"))
    return ranked.withColumn("__gl_rank", rank).join(F.broadcast(offsets), "__gl_bin").withColumn("__gl_row", F.col("__gl_before") + F.col("__gl_rank") - 1).drop("__gl_bin", "__gl_rank", "__gl_before"), total


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``, ``shard`` and ``slot`` under the law ``rows``.

    Null text counts as empty, a null key as the smallest; repeated rows are rows of their own. Other columns are kept
    unless they are named as an output; the text itself is left out. An empty table gives an empty result.
    """
    docs = docs.drop(*(c for c in OUTPUTS if c not in (key, text)))
    rows, n = numbered(docs, key, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, k = place(np.asarray(b.column("__gl_row")), n, shards, seed)
            yield b.drop_columns(["__gl_row"]).append_column("shard", pa.array(s, pa.int32())).append_column("slot", pa.array(k, pa.int64()))

    schema = T.StructType([f for f in rows.schema.fields if f.name != "__gl_row"] + [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return rows.mapInArrow(run, schema).withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *OUTPUTS)


QUERIES = {"op9_sharding": op9_sharding}
ORACLES: dict[str, str] = {}
