"""SimHash near-duplicates by covering locality-sensitive hashing.

A map of the 64 bits to vectors of ``radius + 1`` bits gives one mask for each non-zero vector v: the bits whose vector
has an odd scalar product with v. Whatever ``radius`` bits differ, some v is orthogonal to all of their vectors, so its
mask leaves them out: every pair within the radius collides in at least one of the ``2 ** (radius + 1) - 1`` tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.checkpoints import checkpoint
from graphloom.llm.common import U64, bytes_of, chunks, hand_back, mix64, partitions, table
from graphloom.operators.components import connected_components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Colliding fingerprints beyond which a table's entry is split by masks of its own.
SPLIT = 256


def masks(radius: int, salt: int) -> np.ndarray:
    """The covering masks for ``radius``; each bit's vector is uniform and fixed by the salt."""
    vectors = mix64(np.arange(1, 65, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt)) % U64(1 << (radius + 1))
    tests = np.arange(1, 1 << (radius + 1), dtype=U64)
    odd = np.bitwise_count(tests[:, None] & vectors[None, :]) & 1
    return (odd.astype(U64) << np.arange(64, dtype=U64)[None, :]).sum(axis=1, dtype=U64)


def fingerprints(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """A bit is 1 if it is set in more than half of the shingles' hashes."""
    out = np.zeros(len(texts), U64)
    hashed = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        words = (text or b"").lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            hashes = [hashed(joined, SEED)]
        else:
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            ends = np.cumsum(lengths)
            begins = (ends - lengths)[: len(words) - shingle + 1].tolist()
            hashes = [hashed(joined[a:b], SEED) for a, b in zip(begins, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
        total, n = np.zeros(64, np.int64), len(hashes)
        for at in range(0, n, 65536):
            part = np.array(hashes[at : at + 65536], "<u8")
            total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * total > n, bitorder="little").view("<u8")[0]
    return out


def _fingerprint(key: str, text: str, shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text, 8 << 20):
            prints = fingerprints(bytes_of(part.column(text).combine_chunks()), shingle)
            yield from part.drop_columns([text]).append_column("fingerprint", pa.array(prints.view(np.int64), pa.int64())).combine_chunks().to_batches()
        hand_back()

    return run


def forest(prints: np.ndarray, radius: int, depth: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within the radius that keep the components of ``prints`` (distinct), without listing all pairs.

    A small set is compared row by row, each fingerprint found being left out of later searches. A large one is first
    cut by covering masks of its own, whose entries are far smaller; what they can't cut is compared row by row.
    """
    if len(prints) > SPLIT and depth < 2:
        links = []
        for mask in masks(radius, 1000 + depth).tolist():
            masked = prints & U64(mask)
            order = np.argsort(masked, kind="stable")
            cuts = np.flatnonzero(np.diff(masked[order], prepend=~masked[order[:1]]))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
                if b - a > 1:
                    links += forest(prints[order[a:b]], radius, depth + 1)
        return links
    links = []
    left = prints
    queue: list[np.ndarray] = []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
            if not len(left):
                break
        at = queue.pop()
        near = np.bitwise_count(left ^ at) <= radius
        if near.any():
            found = left[near]
            links.append((np.full(len(found), at), found))
            queue += list(found)
            left = left[~near]
    return links


def _collide(radius: int):
    def run(group: pa.Table) -> pa.Table:
        which = np.asarray(group.column("t").combine_chunks()).astype(np.int64)
        prints = np.asarray(group.column("fingerprint").combine_chunks()).view(U64)
        masked = prints & masks(radius, 0)[which]
        order = np.lexsort((prints, masked, which))
        which, masked, prints = which[order], masked[order], prints[order]
        new = np.ones(len(prints), bool)
        new[1:] = (which[1:] != which[:-1]) | (masked[1:] != masked[:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(prints)))
        pair = head[size == 2]
        pair = pair[np.bitwise_count(prints[pair] ^ prints[pair + 1]) <= radius] if len(pair) else pair
        links = [(prints[pair], prints[pair + 1])]
        for a, n in zip(head[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            links += forest(prints[a : a + n], radius)
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*links, strict=True))
        return pa.table([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    return run


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (long, the bits as signed) and ``component_id`` (the smallest key reachable by links).

    Two rows link if their fingerprints differ in at most ``radius`` bits. Rows of one fingerprint are one node, so
    copies are never paired. Null or wordless text has fingerprint zero and links like any other. A row with a null
    key takes part in links, but never names a component; a component of such rows only has a null ``component_id``.
    Rows that repeat a key are rows of their own. Keys are whole numbers; one that cannot be cast to a long raises an
    error. Other columns are left out; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prints = checkpoint(docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("__gl_text")).mapInArrow(_fingerprint(key, "__gl_text", shingle), f"{key} long, fingerprint long"))
    nodes = checkpoint(prints.groupBy("fingerprint").agg(F.min(key).alias("least")))
    cover = masks(radius, 0).view(np.int64).tolist()
    entries = nodes.select("fingerprint", F.posexplode(F.array(*map(F.lit, cover))).alias("t", "m"))
    buckets = 8 * partitions(spark)
    placed = entries.select("fingerprint", F.col("t").cast("int").alias("t"), F.pmod(F.xxhash64("t", F.col("fingerprint").bitwiseAND(F.col("m"))), F.lit(buckets)).cast("int").alias("bucket"))
    links = placed.groupBy("bucket").applyInArrow(_collide(radius), "a long, b long")
    found = connected_components(links).withColumnRenamed("node", "fingerprint")
    # what is joined is written before, so that a component or fingerprint with many rows can be dealt to several tasks
    least = checkpoint(found.join(nodes, "fingerprint").groupBy("component").agg(F.min("least").alias("component_id")))
    named = checkpoint(found.join(least, "component").select("fingerprint", F.col("component_id").alias("__gl_least")))
    every = checkpoint(nodes.join(named, "fingerprint", "left").select("fingerprint", F.coalesce("__gl_least", "least").alias("component_id")))
    return prints.join(every, "fingerprint").select(key, "fingerprint", "component_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op5_simhash": op5_simhash}
ORACLES: dict[str, str] = {}
