"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node that has an edge.

    Alternating star contraction: every node is tied to the smallest node around it, first for larger neighbours, then
    for smaller ones, until nothing moves. Minima are combined before they are shuffled, so a node with very many
    neighbours is no large group; each round's edges are checkpointed and no more in number than the distinct edges
    before. Null nodes and loops are left out; repeated edges count once; no edges give no rows.
    """
    now = checkpointed(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    )
    before = _digest(now)
    while before[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = checkpointed(small.union(least).distinct())
        after = _digest(now)
        if after == before:
            break
        before = after
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select(F.col("v"), F.col("v")))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003), F.bit_xor(F.xxhash64("u", "v"))).first())
