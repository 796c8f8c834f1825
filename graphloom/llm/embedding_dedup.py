"""Embedding near-duplicates by a pivot-permutation index.

Each vector is described by its nearest reference points (pivots), nearest first, seen from the centre of the data:
where all vectors lean one way, what tells them apart is what is left beside that. Inverted lists by pivot bring together
vectors that share one, and are cut into the sublists that share a second; only pairs of a sublist are verified, by
cosine in double precision, in the list and sublist of the smallest two pivots they share, so every pair counts once.

How many pivots a description holds is fitted: the fewest by which pairs made at the threshold, on either side of sampled
vectors, share enough of them. Sample and pivots are bounded by ``MOST_PIVOTS``; every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.checkpoints import checkpoint
from graphloom.llm.common import partitions, release, table
from graphloom.operators.components import connected_components

COSINE = 0.93
#: Pivots that a candidate pair shares at least.
SHARED = 2
#: Pivots that a description may hold, and the share of pairs made at the threshold that have to share enough of them.
NEAREST, RECALL = (6, 8, 10, 12, 16, 20, 24, 32, 48, 64), 0.985
#: Bounds of the number of pivots, which follows the square root of the number of different vectors.
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
#: Sampled vectors at which pairs are made.
TRIED = 512
#: Cosine, seen from the centre, below which pivots are to each other.
APART = 0.8
#: Vectors of a list, or sublist, that one block holds; longer sublists are verified block against block.
BLOCK = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x /= np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), np.finfo(float).tiny)


class Pivots:
    """Centre, pivots and length of a description for vectors of one dimension."""

    def __init__(self, sample: np.ndarray, dim: int, cosine: float = COSINE, shared: int = SHARED) -> None:
        points = unit(sample) if len(sample) else np.zeros((0, dim))
        self.centre = points.mean(axis=0) if len(points) > 1 else np.zeros(dim)
        own = unit(points - self.centre)
        kept = np.zeros((len(own), dim))
        n = 0
        for v in own:  # a crowd of like vectors would else fill the sample, and its nearest pivots be a matter of chance
            if not n or (kept[:n] @ v).max() < APART:
                kept[n], n = v, n + 1
        rng = np.random.default_rng(dim)
        self.pivots = np.vstack([kept[:n], unit(rng.standard_normal((max(0, LEAST_PIVOTS - n), dim)))])
        self.nearest = NEAREST[2]
        if len(points) > 1 and dim > 1:
            self.nearest = self._fit(points[:TRIED], rng, cosine, shared)

    def _fit(self, points: np.ndarray, rng: np.random.Generator, cosine: float, shared: int) -> int:
        """The shortest description by which enough pairs at the threshold share ``shared`` pivots."""
        asides = [rng.standard_normal(points.shape), np.roll(points, 1, axis=0)]  # any way, and the way other vectors lie
        most = min(NEAREST[-1], len(self.pivots))
        mine, found = self.describe(points, most), []
        for aside in asides:
            aside = aside - (aside * points).sum(axis=1, keepdims=True) * points
            usable = np.sqrt((aside * aside).sum(axis=1)) > 1e-6
            other = self.describe(cosine * points + (1 - cosine * cosine) ** 0.5 * unit(aside), most)
            found += [(mine[usable], other[usable])]
        for k in NEAREST:
            if all(len(a) == 0 or ((a[:, :k, None] == b[:, None, :k]).any(axis=2).sum(axis=1) >= shared).mean() >= RECALL for a, b in found):
                return k
        return NEAREST[-1]

    def describe(self, points: np.ndarray, nearest: int | None = None) -> np.ndarray:
        """Numbers of each point's nearest pivots, nearest first."""
        nearest = min(nearest or self.nearest, len(self.pivots))
        out = np.empty((len(points), nearest), np.int32)
        for at in range(0, len(points), 1024):
            score = -(unit(points[at : at + 1024] - self.centre) @ self.pivots.T)
            some = np.argpartition(score, nearest - 1, axis=1)[:, :nearest]
            out[at : at + 1024] = np.take_along_axis(some, np.argsort(np.take_along_axis(score, some, axis=1), axis=1, kind="stable"), axis=1)
        return out


def _describe(fitted: Broadcast, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(fitted.value)
        for batch in batches:
            rows = [np.array(v, np.float64) for v in batch.column("embedding").to_pylist()]
            found: list = [None] * len(rows)
            for dim in {len(v) for v in rows}:
                own = [k for k, v in enumerate(rows) if len(v) == dim]
                if dim not in known:
                    known[dim] = Pivots(np.zeros((0, dim)), dim)
                for k, p in zip(own, known[dim].describe(unit(np.array([rows[k] for k in own]))), strict=True):
                    found[k] = p.tolist()
            arrays = [batch.column(c) for c in ("label", "node", "weight")] + [pa.array([v.astype(kind).tobytes() for v in rows], pa.binary()), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["label", "node", "weight", "vector", "pivots"])

    return run


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number reachable from each of n nodes over pairs (a, b)."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _sublists(p: np.ndarray, pivot: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each larger pivot that several members of a pivot's list have, with those members."""
    member, place = np.nonzero(p > pivot)
    other = p[member, place]
    order = np.argsort(other, kind="stable")
    member, other = member[order], other[order]
    cuts = np.flatnonzero(np.diff(other, prepend=-1))
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(other)).tolist(), strict=False):
        if b - a > 1:
            yield int(other[a]), member[a:b]


def _verify(cosine: float, shared: int, kind: str):
    def pairs(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, pivot: int, second: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs at the threshold whose smallest shared pivots are ``pivot`` and, where two are asked for, ``second``."""
        a, b = np.nonzero(x @ y.T >= cosine)
        if same:
            a, b = a[a < b], b[a < b]
        keep = np.zeros(len(a), bool)
        for at in range(0, len(a), 8192):
            p = px[a[at : at + 8192]]
            both = (p[:, :, None] == py[b[at : at + 8192]][:, None, :]).any(axis=2) & (p >= 0)
            least = np.sort(np.where(both, p, np.iinfo(np.int32).max), axis=1)
            keep[at : at + 8192] = (least[:, 0] == pivot) & ((shared < 2) | (least[:, min(1, least.shape[1] - 1)] == second))
        return a[keep], b[keep]

    @release
    def run(group: pa.Table) -> pa.Table:
        lists = ("label", "dim", "pivot", "second", "low", "high")
        group = group.sort_by([(c, "ascending") for c in (*lists, "own", "node")])
        key = np.stack([np.asarray(group.column(c).combine_chunks()).astype(np.int64) for c in lists], axis=1)
        own, node, weight = (np.asarray(group.column(c).combine_chunks()) for c in ("own", "node", "weight"))
        vectors = group.column("vector").to_pylist()
        nearest = group.column("pivots").to_pylist()
        wide = max(map(len, nearest))
        heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        out: list[list] = [[], [], []]
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(key)], strict=True):
            if b - a < 2:
                continue
            x = unit(np.array([np.frombuffer(v, kind) for v in vectors[a:b]]))
            p = np.array([[*q, *[-1] * (wide - len(q))] for q in nearest[a:b]], np.int32)
            pivot, second, low, high = key[a, 2:].tolist()
            if low != high:
                m = int(np.count_nonzero(own[a:b] == low))
                i, j = pairs(x[:m], x[m:], p[:m], p[m:], pivot, second, False)
                j = j + m
            elif shared < 2 or second >= 0:
                i, j = pairs(x, x, p, p, pivot, second, True)
            else:
                found = [(rows, pairs(x[rows], x[rows], p[rows], p[rows], pivot, q, True)) for q, rows in _sublists(p, pivot)]
                i, j = (np.concatenate([rows[hit[k]] for rows, hit in found]) if found else np.zeros(0, np.int64) for k in range(2))
            if not len(i):
                continue
            w, r = weight[a:b], node[a:b]
            links = np.bincount(i, w[j], b - a) + np.bincount(j, w[i], b - a)
            root = _stars(b - a, i, j)
            hit = np.flatnonzero(links)
            for values, v in zip(out, (r[hit], links[hit].astype(np.int64), r[root[hit]]), strict=True):
                values.append(v)
        arrays = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in out]
        return pa.table([pa.array(v, pa.int64()) for v in arrays], ["node", "links", "root"])

    return run


def usable(embedding: str):
    """The embedding, or null if it links with nothing: null, empty, zero, or with a null or non-finite component."""
    c = F.col(embedding)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad & F.exists(c, lambda x: x != 0), c)


def fit(nodes: DataFrame, cosine: float = COSINE, shared: int = SHARED) -> tuple[dict[int, Pivots], int]:
    """Pivots by dimension, from a sample of ``nodes`` (node, embedding) chosen by a hash, and the count of nodes."""
    count = nodes.count()
    number = int(min(max(LEAST_PIVOTS, 4 * count**0.5), MOST_PIVOTS))
    sample = [np.array(r[0], np.float64) for r in nodes.orderBy(F.xxhash64("embedding"), "rep").limit(number).select("embedding").collect()]
    return {dim: Pivots(np.array([v for v in sample if len(v) == dim]), dim, cosine, shared) for dim in sorted({len(v) for v in sample})}, count


def embedding_groups(rows: DataFrame, cosine: float = COSINE, shared: int = SHARED, key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``key``, ``n_links`` (other rows linked directly) and ``component_id`` (smallest key reachable), one row a vector.

    Rows link if their labels are equal, their vectors have one length and the cosine is at least ``cosine``. Equal
    vectors of a label are one node with a weight; they are never paired with each other, but count. Rows with a null
    label or key, or an unusable vector, link with nothing. Rows that repeat a key are vectors of their own, and join
    nothing by it. Keys and labels are whole numbers; one that cannot be cast to a long raises an error. Other columns are
    left out; an empty table gives an empty result.

    No list is cut short: a list of over ``BLOCK`` vectors is dealt by second pivots, and a sublist that is still longer
    block against block.
    """
    spark = rows.sparkSession
    kind = "<f4" if dict(rows.dtypes)[embedding] == "array<float>" else "<f8"
    rows = rows.select(F.col(key).cast("long").alias(key), F.col(label).cast("long").alias("label"), usable(embedding).alias("embedding")).withColumn("embedding", F.when(F.col("label").isNotNull() & F.col(key).isNotNull(), F.col("embedding")))
    nodes = checkpoint(rows.where("embedding IS NOT NULL").groupBy("label", "embedding").agg(F.min(key).alias("rep"), F.count("*").alias("weight")).withColumn("node", F.monotonically_increasing_id()))
    fitted, count = fit(nodes, cosine, shared)
    longest = max([p.nearest for p in fitted.values()], default=NEAREST[0])
    width = max(8 * partitions(spark), count * longest // (8 * BLOCK))
    described = checkpoint(nodes.mapInArrow(_describe(spark.sparkContext.broadcast(fitted), kind), "label long, node long, weight long, vector binary, pivots array<int>"))
    entries = described.withColumn("dim", F.length("vector")).withColumn("pivot", F.explode("pivots")).withColumn("second", F.lit(-1))
    lists = ["label", "dim", "pivot", "second"]

    def over(entries: DataFrame) -> DataFrame:
        return entries.groupBy(*lists).count().where(F.col("count") > BLOCK)

    if shared > 1:
        long = checkpoint(over(entries).select(*lists[:3]))
        seconds = F.filter("pivots", lambda q: q > F.col("pivot"))
        cut = entries.join(long, lists[:3], "left_semi").withColumn("second", F.explode(seconds))
        entries = entries.join(long, lists[:3], "left_anti").select(cut.columns).union(cut)
    long = checkpoint(over(entries).select(*lists, F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")))
    split = entries.join(long, lists, "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    blocks = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    dealt = blocks.withColumn("bucket", F.pmod(F.xxhash64(*lists, "low", "high"), F.lit(width)).cast("int")).select("bucket", *lists, "low", "high", "own", "node", "weight", "vector", "pivots")
    found = checkpoint(dealt.groupBy("bucket").applyInArrow(_verify(cosine, shared, kind), "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("node <> root"), "node", "root")
    least = checkpoint(parts.join(nodes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("component_id")))
    named = nodes.join(links, "node", "left").join(parts, "node", "left").join(least, "component", "left")
    named = checkpoint(named.select("label", "embedding", F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    return rows.join(named, ["label", "embedding"], "left").select(key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", key).alias("component_id"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings")).withColumn("kept", F.col("vec_id") == F.col("component_id"))


QUERIES = {"op10_embedding_dedup": op10_embedding_dedup}
ORACLES: dict[str, str] = {}
