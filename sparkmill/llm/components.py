"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima and joins over the edges; every round is written to the
shared folder, so lineage stays short and no edge reaches the driver (only a checksum does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, discard, materialize

#: Bytes of a node and its least neighbour in a broadcast.
_NODE = 64


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, component): each node that has an edge, with the least node reachable.

    The least neighbours are joined by broadcast where the number of edges proves that they fit;
    else they are written, so that both sides of the join are shuffled for it and Spark can split skewed nodes.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "edges")
    state = _state(e)
    while state[0]:
        fits = 2 * state[0] * _NODE <= BROADCAST_BYTES  # an edge has two nodes
        old = [e]

        def written(df, name):
            old.append(materialize(df, name))
            return old[-1]

        minima = F.broadcast if fits else lambda df: written(df, "least")  # noqa: B023
        # Large star: a node's greater neighbours hang from its least neighbour.
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = minima(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large if fits else written(large, "edges")
        # Small star: a node and its lesser neighbours hang from the least of them.
        low = minima(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = joined.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        e = materialize(small, "edges")
        before, state = state, _state(e)
        for df in old:  # the next round reads only what this one has written last
            discard(df)
        if state == before:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(e: DataFrame) -> tuple:
    """The number of edges and a checksum of them."""
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
