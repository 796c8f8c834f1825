"""Connected components of a graph given as a table of links, wholly distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.checkpoints import checkpoint


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node that ``links`` names.

    Each round points every node to its smallest neighbour, follows the pointers to their roots, and contracts the
    links to links between roots, so the table shrinks at least by half; rounds are as many as the logarithm of the
    longest chain. Null ends are dropped, loops give their node itself; an empty table gives an empty result.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    edges = checkpoint(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    result = edges.select("a").union(edges.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    edges = edges.where("a <> b")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = checkpoint(both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")))
        while True:
            up = parents.select(F.col("a").alias("p"), F.col("p").alias("up"))
            jumped = checkpoint(parents.join(up, "p", "left").select("a", F.coalesce("up", "p").alias("p"), (F.col("up") < F.col("p")).alias("moved")))
            parents = jumped.select("a", "p")
            if jumped.where("moved").isEmpty():
                break
        to = parents.select(F.col("a").alias("component"), "p")
        result = checkpoint(result.join(to, "component", "left").select("node", F.coalesce("p", "component").alias("component")))
        ends = edges.join(parents.withColumnsRenamed({"p": "pa"}), "a", "left").join(parents.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b", "left")
        edges = checkpoint(ends.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a <> b").distinct())
    return result
