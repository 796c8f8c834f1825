"""The suffix array of a whole corpus by the distributed difference cover, and the repeats that adjacent suffixes show.

Positions of all texts are numbered through. Suffixes at two of three positions are named by their triples, which one
global sort puts in order; while names repeat, the string of names is ranked the same way, being two thirds as long. The
others are sorted by a first symbol and the rank behind it, and merged by counting, in two more global sorts, how many
of the one kind stand before each of the other. Adjacent suffixes with equal prefixes are repeats.

This is the algorithm in full, with nothing collected but the row counts of partitions. Each level sorts its whole string
several times, at some thirty bytes a position: see the README for what that costs. ``suffix_dedup`` therefore brings
equal windows together by minimisers first, and orders suffixes by the difference cover inside their buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.checkpoints import checkpoint
from graphloom.llm.common import partitions

#: Consecutive positions that are read together for what stands behind each.
BLOCK = 1 << 16


def in_order(rows: DataFrame, keys: list[str], counted: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each of ``counted``, the number of rows up to and including this one, in the order of ``keys``,
    for which it holds, or the sum of their values. Rows are cut into sorted ranges, and only sums of ranges are put together."""
    ranges = checkpoint(rows.repartitionByRange(2 * partitions(rows.sparkSession), *keys).withColumn("__gl_range", F.spark_partition_id()))
    upto = Window.partitionBy("__gl_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    sums = ranges.groupBy("__gl_range").agg(*[F.sum(c.cast("long")).alias(f"__gl_{n}") for n, c in counted.items()])
    before = Window.orderBy("__gl_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sums = sums.select("__gl_range", *[F.coalesce(F.sum(f"__gl_{n}").over(before), F.lit(0)).alias(f"__gl_{n}") for n in counted])
    out = ranges.join(F.broadcast(sums), "__gl_range")
    return out.select(*rows.columns, *[(F.sum(c.cast("long")).over(upto) + F.col(f"__gl_{n}")).alias(n) for n, c in counted.items()])


def behind(symbols: DataFrame, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """``symbols`` (i, ...) with columns that hold another column's value some positions on, 0 at the end."""
    own = F.floor(F.col("i") / BLOCK)
    most = max(k for _, k in columns.values())
    both = F.when((F.col("i") % BLOCK < most) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    w = Window.partitionBy("__gl_block").orderBy("i")
    out = symbols.withColumn("__gl_block", F.explode(both)).withColumns({n: F.coalesce(F.lead(c, k).over(w), F.lit(0)) for n, (c, k) in columns.items()})
    return out.where(F.col("__gl_block") == own).drop("__gl_block")


def suffix_ranks(symbols: DataFrame, n: int) -> DataFrame:
    """(i, rank): the place, from 1, of each suffix of a string of ``n`` symbols (i, c), c from 1 on, among all."""
    s = checkpoint(behind(symbols.select("i", F.col("c").cast("long").alias("c")), {"c1": ("c", 1), "c2": ("c", 2)}))
    sample = s.where("i % 3 <> 0")
    ones = (n + 1) // 3
    if n % 3 == 1:  # a sampled suffix of length 0 keeps those of the first kind from running into the second
        sample, ones = sample.union(symbols.sparkSession.range(1).select(F.lit(n).cast("long"), *[F.lit(0).cast("long")] * 3)), ones + 1
    triples = in_order(sample.select("c", "c1", "c2").distinct(), ["c", "c1", "c2"], {"name": F.lit(True)})
    named = checkpoint(sample.join(triples, ["c", "c1", "c2"]).select("i", "name"))
    if triples.count() < named.count():
        at = F.when(F.col("i") % 3 == 1, F.floor(F.col("i") / 3)).otherwise(F.floor(F.col("i") / 3) + ones)
        inner = suffix_ranks(named.select(at.alias("i"), F.col("name").alias("c")), named.count())
        back = F.when(F.col("i") < ones, F.col("i") * 3 + 1).otherwise((F.col("i") - ones) * 3 + 2)
        named = inner.select(back.alias("i"), F.col("rank").alias("name"))
    # ranks of sampled suffixes next to the symbols they begin behind
    placed = checkpoint(behind(s.join(named.withColumnRenamed("name", "own"), "i", "left").select("i", "c", "c1", "own"), {"r1": ("own", 1), "r2": ("own", 2)}))
    kind = F.col("i") % 3
    first = in_order(placed.where(kind < 2).select("i", "own", "c", F.col("r1").alias("r")), ["c", "r"], {"zeros": kind == 0, "others": kind == 1})
    second = in_order(placed.where(kind != 1).select("i", "own", "c", "c1", F.col("r2").alias("r")), ["c", "c1", "r"], {"zeros": kind == 0, "others": kind == 2})
    zero = first.where(kind == 0).select("i", "zeros", F.col("others").alias("a")).join(second.where(kind == 0).select("i", F.col("others").alias("b")), "i").select("i", (F.col("zeros") + F.col("a") + F.col("b")).alias("rank"))
    sampled = first.where(kind == 1).select("i", "own", "zeros").union(second.where(kind == 2).select("i", "own", "zeros"))
    empty = 1 if n % 3 == 1 else 0  # it came first
    return checkpoint(zero.union(sampled.select("i", F.col("own") + F.col("zeros") - empty)))


def repeated_windows(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, at): the windows of ``width`` bytes that also start in a document with a smaller key.

    Null texts and keys take no part. A mark of its own ends each text, so matches never cross texts. An empty table gives
    an empty result.
    """
    sizes = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("raw"))
    texts = checkpoint(in_order(sizes.withColumn("size", F.length("raw") + 1), ["doc", "raw"], {"upto": F.col("size")}).withColumn("base", F.col("upto") - F.col("size")))
    n = texts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if not n:
        return docs.sparkSession.createDataFrame([], f"{key} long, at int")
    at = F.sequence(F.lit(0), F.col("size") - 1)
    symbols = texts.select("doc", "raw", "base", "size", F.explode(at).alias("at"))
    byte = F.when(F.col("at") == F.col("size") - 1, 1).otherwise(F.conv(F.hex(F.substring(F.col("raw"), F.col("at") + 1, F.lit(1))), 16, 10).cast("long") + 2)
    ranks = suffix_ranks(symbols.select((F.col("base") + F.col("at")).alias("i"), byte.alias("c")), n)
    windows = symbols.where(F.col("at") + width < F.col("size")).select((F.col("base") + F.col("at")).alias("i"), "doc", "at", F.substring(F.col("raw"), F.col("at") + 1, F.lit(width)).alias("w"))
    ordered = in_order(windows.join(ranks, "i").select("rank", "doc", "at", "w"), ["rank"], {"k": F.lit(True)})
    # adjacent prefixes: a range of suffixes knows the prefix before it from the last row of the range before
    ranges = checkpoint(ordered.repartitionByRange(2 * partitions(docs.sparkSession), "k").withColumn("range", F.spark_partition_id()))
    ends = ranges.groupBy("range").agg(F.max_by("w", "k").alias("end"))
    ends = ends.select(F.lead("range").over(Window.orderBy("range")).alias("range"), "end")
    own = Window.partitionBy("range").orderBy("k")
    before = F.coalesce(F.lag("w").over(own), F.col("end"))
    marked = ranges.join(F.broadcast(ends), "range", "left").withColumn("new", ~F.coalesce(F.col("w") == before, F.lit(False)))
    runs = in_order(marked.select("k", "doc", "at", "new"), ["k"], {"run": F.col("new")})
    least = runs.groupBy("run").agg(F.min("doc").alias("least"))
    return runs.join(least, "run").where("doc > least").select(F.col("doc").alias(key), "at")
