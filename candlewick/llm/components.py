"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m) for both directions of every edge; m is the least of u and its neighbours."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the least node around u."""
    return _least(edges).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of them (edges run from large to small)."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    joined = down.join(least, F.col("u") == F.col("k"))
    return (joined.select(F.col("v").alias("a"), "m").union(joined.select(F.col("u").alias("a"), "m"))
            .where("a <> m").distinct().toDF("u", "v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long); component is the least node reachable.

    A round needs a few shuffles of the edges, and the number of rounds grows with the logarithm of
    a component's width; every round is a written table, so a lost executor costs one round at most.
    The least neighbour of a node is combined before the shuffle; the join that hands it back to the
    node's edges is a shuffle join, which Spark splits where one node has very many.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = stored(_small_star(_large_star(edges)), "edges")
    stars = edges.toDF("node", "component")
    return stars.union(stars.select("component", "component").distinct())
