"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, reliable, scratch


#: Edges that one task may hold for a node; nodes with more are at most twice FEW_HUBS, so they may be broadcast.
HUB, FEW_HUBS = 2_000, 50_000


def _least(pairs: DataFrame, bound: int, most: int) -> DataFrame:
    """Pairs (u, v) with m, the smallest v of u. Nodes of more than `bound` pairs get it from partial aggregates, the others
    from a window, in which the pairs of the former are dealt by v."""
    if most <= bound:  # no node can have so many
        return pairs.select("u", "v", F.min("v").over(Window.partitionBy("u")).alias("m"))
    heavy = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).where(F.col("n") > bound).select(F.col("u").alias("hub"), F.col("m").alias("known"))
    every = pairs.join(F.broadcast(heavy), F.col("u") == F.col("hub"), "left").withColumn("deal", F.when(F.col("hub").isNotNull(), F.col("v")))
    return every.select("u", "v", F.coalesce("known", F.min("v").over(Window.partitionBy("u", "deal"))).alias("m"))


def _round(now: DataFrame, bound: int, edges: int) -> DataFrame:
    """Each node points its larger neighbours to its smallest one, then its smaller ones and itself."""
    pair = lambda x, y: F.struct(F.col(x).alias("u"), F.col(y).alias("v"))
    both = now.select(F.explode(F.array(pair("u", "v"), pair("v", "u"))).alias("e")).select("e.*")
    large = _least(both, bound, edges).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    small = _least(large.distinct(), bound, edges)
    return small.select(F.explode(F.array(pair("u", "m"), pair("v", "m"))).alias("e")).select("e.*").where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", hub: int = HUB) -> DataFrame:
    """node, root for each node of an edge with another: root is the smallest node of its component.

    Alternating star contraction: the edges stay distributed, a round is two minima over them, and the number of rounds
    grows with the logarithm of the longest chain. Each round cuts the lineage by checkpoint(). A hub's edges never come
    together in one task: the bound on a node's edges grows with their number, so that hubs are few. Loops and repeated edges
    count once; edges with a null are left out; no edges, no rows.
    """
    with scratch(edges.sparkSession) as keep:
        now = reliable(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
        state = (now.count(), None)
        while state[0]:
            last, now = now, reliable(_round(now, max(hub, state[0] // FEW_HUBS), state[0]))
            forget(last)
            seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
            if seen == state:
                break
            state = seen
        keep.append(now)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
