"""Canonical entities: adaptation of parser output, rules, merge, and deduplication."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions import names, tables
from graphloom.operators.components import connected_components

#: Keys by which parsers give one thing, in the order in which they are looked at.
SOURCE_KEYS = {
    "repository": ("repository", "repo", "repo_name"), "module": ("module", "module_name"), "document": ("document", "doc_name", "file_name", "api_title"),
    "file_path": ("file_path", "path", "spec_file", "spec_source"), "version_tag": ("version", "version_tag", "version_source"),
}


def mean(value: Column, digits: int = 4) -> Column:
    """A mean whose sum is exact, rounded half up, so that it doesn't depend on the order of rows."""
    exact = F.sum(value.cast("decimal(20,8)")).cast("double") / F.count(value)
    return F.floor(exact * 10**digits + 0.5) / float(10**digits)


def adapt_sources(entities: DataFrame, properties: str = "properties") -> DataFrame:
    """Provenance columns from a map of properties: the first non-blank value of each group of keys."""
    at = lambda k: F.try_element_at(F.col(properties), F.lit(k))
    out = entities
    for name, keys in SOURCE_KEYS.items():
        out = out.withColumn(name, names.first_non_blank(*map(at, keys)))
    score = [at(k).try_cast("double") for k in ("confidence", "score")]
    return out.withColumn("confidence", F.coalesce(*[F.when(s.between(0, 1), s) for s in score], F.lit(1.0)))


def canonicalise(entities: DataFrame) -> DataFrame:
    """``canonical_id`` and ``canonical_type`` from ``name``, ``type`` and ``source_parser``; rows without a name go.

    Each rule is a projection of its own, as rules use their input more than once; no rule makes a name blank, so the
    filter stands first, where it can be pushed to the scan.
    """
    out = entities.where(names.strip(F.col("name")) != "").withColumn("canonical_id", F.col("name"))
    for rule in names.RULES:
        c = F.col("canonical_id")
        out = out.withColumn("canonical_id", F.coalesce(rule(c, F.col("source_parser")), c))
    return out.withColumn("canonical_id", names.strip(F.col("canonical_id"))).withColumn("canonical_type", names.canonical_type(F.col("type")))


def merge(entities: DataFrame) -> DataFrame:
    """One row per canonical id: first type, distinct aliases in order, number of sources, mean confidence.

    ``pos`` orders rows. Rows are summed up by canonical id and name first, so a name that many rows share is one row
    when aliases are gathered; an entity gathers its different names only.
    """
    vector = ["embedding"] if "embedding" in entities.columns else []
    seen = F.when(F.col("embedding").isNotNull(), F.col("pos")) if vector else None
    exact = F.sum(F.col("confidence").cast("decimal(20,8)"))
    typed = F.min(F.struct("pos", "canonical_type"))
    by_name = entities.groupBy("canonical_id", "name").agg(typed.alias("t"), F.min("pos").alias("pos"), F.count("*").alias("n"), F.count("confidence").alias("k"), exact.alias("s"), *[F.min(F.when(seen.isNotNull(), F.struct(F.col("pos"), F.col("embedding")))).alias("v") for _ in vector])
    alias = F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda s: s["name"])
    confidence = F.floor(F.sum("s").cast("double") / F.sum("k") * 10**4 + 0.5) / 1e4
    return by_name.groupBy("canonical_id").agg(
        F.min("t")["canonical_type"].alias("type"), alias.alias("aliases"), F.sum("n").alias("n_sources"), confidence.alias("confidence"), *[F.min("v")["embedding"].alias(x) for x in vector],
    )


def name_keys(entities: DataFrame, key: str = "id", aliases: str = "aliases") -> DataFrame:
    """(``id``, ``match``) for the id and aliases of each entity."""
    listed = F.array_distinct(F.transform(F.concat(F.array(F.col(key)), F.coalesce(F.col(aliases), F.array().cast("array<string>"))), names.match_key))
    return entities.select(F.col(key).alias("id"), F.explode(F.filter(listed, lambda x: x != "")).alias("match"))


def _to_hub(keys: DataFrame, score: float, reason: str) -> DataFrame:
    """Links of all holders of a key to its smallest holder: as many as rows, whatever the size of the group."""
    hubs = keys.groupBy("match").agg(F.min("id").alias("left"))
    return keys.join(hubs, "match").where("id <> left").select("left", F.col("id").alias("right"), F.lit(score).alias("score"), F.lit(reason).alias("reason"))


def exact_alias_links(entities: DataFrame) -> DataFrame:
    return _to_hub(name_keys(entities), 1.0, "exact_alias").distinct()


def domain_links(entities: DataFrame, groups: dict[str, list[str]] = tables.DOMAINS) -> DataFrame:
    """Entities with a name of the same domain group."""
    plain = lambda s: re.sub(r"[\s_\-./\\|]+", "", s).lower()
    known = {plain(a): plain(k) for k, listed in groups.items() for a in [k, *listed]}
    keys = name_keys(entities).withColumn("match", names.lookup(F.col("match"), known)).where("match IS NOT NULL").distinct()
    return _to_hub(keys, 0.96, "domain_mapping").distinct()


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left, right):
    """The similarity of matching blocks, left as the first sequence."""
    from difflib import SequenceMatcher

    import pandas as pd

    return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)])


def similar_names(entities: DataFrame, threshold: float = 0.88) -> DataFrame:
    """Pairs of different match keys whose ratio reaches the threshold, which is 0.8 at least.

    At ratio r, names of a and b characters match in at least r (a + b) / 2 of them, in at most (1 - r) (a + b) + 1
    blocks, so they share all but few of their adjacent pairs. Each name is looked up by its rarest pairs only, as many
    as make sure that two such names meet (prefix filtering); a pair that is common in the corpus is hardly ever a key.
    """
    keys = name_keys(entities).select("match").distinct().withColumn("n", F.length("match")).where("n > 1")
    pairs = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: F.substr("match", i, F.lit(2)))
    grams = keys.select("match", "n", F.posexplode(pairs).alias("at", "gram"))
    grams = grams.withColumn("gram", F.concat("gram", F.row_number().over(Window.partitionBy("match", "gram").orderBy("at"))))
    counted = grams.join(grams.groupBy("gram").agg(F.count("*").alias("common")), "gram")
    # the shortest partner has a r / (2 - r) characters
    least = threshold / (2 - threshold)
    shared = F.greatest(F.ceil(F.col("n") * (threshold * (1 + least) / 2 - (1 - threshold) * (1 + least)) - 1 - 1e-9), F.lit(1))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("match").orderBy("common", "gram"))).where(F.col("rank") <= F.col("n") - shared)
    a, b = ranked.alias("a"), ranked.alias("b")
    near = (F.col("a.match") < F.col("b.match")) & (F.greatest("a.n", "b.n") * threshold <= F.least("a.n", "b.n") * (2 - threshold) + 1e-9)
    found = a.join(b, F.col("a.gram") == F.col("b.gram")).where(near).select(F.col("a.match").alias("left"), F.col("b.match").alias("right")).distinct()
    return found.withColumn("score", sequence_ratio("left", "right")).where(F.col("score") >= threshold)


def similar_name_links(entities: DataFrame, threshold: float = 0.88) -> DataFrame:
    """Links between the smallest holders of similar names; exact links tie the other holders to these."""
    hubs = name_keys(entities).groupBy("match").agg(F.min("id").alias("id"))
    a, b = (hubs.select(F.col("match").alias(side), F.col("id").alias(f"{side}_id")) for side in ("left", "right"))
    found = similar_names(entities, threshold).join(a, "left").join(b, "right").where("left_id <> right_id")
    pair = found.select(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right"), "score")
    return pair.groupBy("left", "right").agg(F.round(F.max("score"), 4).alias("score")).withColumn("reason", F.lit("name_similarity"))


def pick_embedding(*vectors: str) -> Column:
    """The first of the columns that holds a vector with a component."""
    return F.coalesce(*[F.when(F.size(v) > 0, F.col(v)) for v in vectors])


def _tile_forest(near) -> list[tuple[int, int]]:
    """Edges (row, column) of a spanning forest of the bipartite graph with this matrix."""
    import numpy as np

    rows, columns, out = near.any(1), np.ones(near.shape[1], bool), []
    for root in np.flatnonzero(rows).tolist():
        queue = [root] if rows[root] else []
        rows[root] = False
        while queue:
            at = queue.pop()
            met = np.flatnonzero(near[at] & columns)
            columns[met] = False
            out += [(at, m) for m in met.tolist()]
            shared = near[:, met]
            reached = np.flatnonzero(rows & shared.any(1))
            rows[reached] = False
            out += zip(reached.tolist(), met[shared[reached].argmax(1)].tolist(), strict=True) if len(reached) else []
            queue += reached.tolist()
    return out


def _pair_forest(x, first, second, threshold: float, tile: int):
    """(row, row, score) of a spanning forest of the links between two sets of rows of unit vectors, tile by tile. Tiles
    whose rows are in one tree already tell nothing new and are passed over; so are tiles that single precision, within
    its error bound, shows to be below the threshold."""
    import numpy as np

    label, single = np.arange(len(x)), x.astype(np.float32)
    surely_below = threshold - (x.shape[1] + 4) * 1.2e-7
    for i in range(0, len(first), tile):
        a = first[i : i + tile]
        for j in range(i if first is second else 0, len(second), tile):
            b = second[j : j + tile]
            if label[a[0]] == label[b[0]] and (label[a] == label[a[0]]).all() and (label[b] == label[b[0]]).all():
                continue
            if (single[a] @ single[b].T).max() < surely_below:
                continue
            score = x[a] @ x[b].T
            near = score >= threshold
            if not near.any():
                continue
            near &= label[a][:, None] != label[b][None, :]
            joined = False
            for r, c in _tile_forest(near):
                u, v = int(a[r]), int(b[c])
                p, q = u, v
                while label[p] != p:
                    p = label[p]
                while label[q] != q:
                    q = label[q]
                if p != q:
                    label[max(p, q)] = min(p, q)
                    joined = True
                    yield u, v, round(float(score[r, c]), 4)
            while joined:
                up = label[label]
                joined, label = bool((up != label).any()), up


#: Vectors of a part at most, and how many parts there are while they hold no more.
PART, PARTS = 65536, 24


def cosine_links(entities: DataFrame, threshold: float = 0.92, block: int = 1024, key: str = "id", vector: str = "embedding") -> DataFrame:
    """Entities whose vectors have a cosine of ``threshold`` at least, whatever their ids; no links without vectors.

    All pairs are compared in double precision, so nothing is missed, and the work grows with the square of the different
    vectors. Vectors are dealt into 24 parts (more where one would hold over 65,536), each of which goes to as many tasks
    as there are parts, so what is shuffled grows with the vectors up to 1.5 million. A task compares two parts in tiles of
    ``block`` vectors and gives a spanning forest of their links, which has the same components.
    """
    import numpy as np
    import pandas as pd

    spark, kind = entities.sparkSession, dict((f.name, f.dataType) for f in entities.schema.fields)[key].simpleString()
    schema = f"left {kind}, right {kind}, score double, reason string"
    if vector not in entities.columns:
        return spark.createDataFrame([], schema)
    rows = entities.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan(norm) & (norm > 1e-24) & (norm < float("inf")))
    hubs = rows.groupBy("v").agg(F.min("id").alias("left"))
    equal = rows.join(hubs, "v").where("id <> left").select("left", F.col("id").alias("right"), F.lit(1.0).alias("score"), F.lit("embedding_similarity").alias("reason"))
    n = hubs.count()
    parts = max(1, min(PARTS, -(-n // block)), -(-n // PART))
    own = hubs.select(F.col("left").alias("id"), "v", F.pmod(F.xxhash64("left"), F.lit(parts)).cast("int").alias("own"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("id", "v", "own", F.size("v").alias("size"), F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        x = np.array(part["v"].tolist(), np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        first = np.flatnonzero(part["own"] == part["a"].iat[0])
        second = first if part["a"].iat[0] == part["b"].iat[0] else np.flatnonzero(part["own"] == part["b"].iat[0])
        ids = part["id"].tolist()
        found = [(ids[u], ids[v], score) for u, v, score in _pair_forest(x, first, second, threshold, block)]
        return pd.DataFrame([(min(a, b), max(a, b), s, "embedding_similarity") for a, b, s in found], columns=["left", "right", "score", "reason"])

    pairs = dealt.repartition(parts * (parts + 1) // 2, "a", "b", "size").groupBy("a", "b", "size")
    return pairs.applyInPandas(compare, schema).union(equal).groupBy("left", "right", "reason").agg(F.max("score").alias("score")).select("left", "right", "score", "reason")


def cosine(a: Column, b: Column) -> Column:
    """0 for vectors of different lengths or without a direction."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v.cast("double") * v))
    return F.when((F.size(a) != F.size(b)) | (norm(a) <= 1e-12) | (norm(b) <= 1e-12), 0.0).otherwise(dot / (norm(a) * norm(b)))


def deduplicate(entities: DataFrame, links: DataFrame) -> DataFrame:
    """Entities (``id``, ``type``, ``aliases``, ``n_sources``, ``confidence``) merged along links.

    The winner of a component has the highest confidence, then the most sources, then the largest id; its id and type
    stay. Aliases are all ids and aliases in the order of ids, confidence the mean of the members'.
    """
    parts = connected_components(links, "left", "right")
    placed = entities.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    winner = F.max_by(F.struct("id", "type"), F.struct("confidence", "n_sources", "id"))
    listed = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("id", "aliases"))), lambda s: F.concat(F.array(s["id"]), s["aliases"]))))
    out = placed.groupBy("component").agg(winner.alias("w"), listed.alias("aliases"), F.sum("n_sources").alias("n_sources"), mean(F.col("confidence")).alias("confidence"), F.array_sort(F.collect_list("id")).alias("members"))
    return out.select(F.col("w.id").alias("id"), F.col("w.type").alias("type"), "aliases", "n_sources", "confidence", "members")


def last_of_name(entities: DataFrame) -> DataFrame:
    """(``lower``, ``id``): the last entity, by ``pos``, that has a name as its id or alias, in lower case."""
    listed = entities.select("id", "pos", F.explode(F.transform(F.concat(F.array("id"), "aliases"), F.lower)).alias("lower"))
    return listed.groupBy("lower").agg(F.max_by("id", "pos").alias("id"))


def first_per(rows: DataFrame, keys: list, order: list) -> DataFrame:
    return rows.withColumn("__gl_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__gl_rank = 1").drop("__gl_rank")
