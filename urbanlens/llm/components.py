"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.text import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the smallest node reachable.

    Large-star links each node's greater neighbours to its smallest neighbour,
    small-star links its smaller ones. Both are an aggregate and a join on the
    node, so a hub's edges are split by the adaptive skew join and nothing is
    gathered. Every round is written to the shared folder; the loop ends when
    a round changes no edge. Null and self edges are dropped.
    """
    e = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before or state[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        e = stored(small, "small-star")
