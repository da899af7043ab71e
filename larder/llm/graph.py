"""Connected components of a graph held in a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources import stage, unstage


def _minima(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each node ``u``, or the node itself.

    Written out, so that the join back to the pairs shuffles both of its sides
    anew and adaptive execution can split the pairs of a hub.
    """
    smallest = F.least("u", F.min("v")).alias("m")
    return stage(pairs.groupBy("u").agg(smallest), "minima")


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of the edges: one row, whatever their number."""
    mixed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mixed).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, component)`` for every node of the edges ``(u, v)``.

    The component is its smallest node. Alternates large-star and small-star
    steps (Kiveris et al., 2014) until the edges form one star per component;
    the number of rounds grows with the logarithm of the longest path. Every
    step is written to the shared folder, and superseded steps are removed.
    Loops, repeated edges and an empty frame are allowed; nodes must not be null.
    """
    higher, lower = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    current = stage(edges.where("u <> v").select(higher, lower).distinct(), "edges")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        minima = _minima(both)
        large = both.join(minima, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        starred = stage(large.where("u <> v").distinct(), "edges")
        nearest = _minima(starred)
        small = starred.join(nearest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = nearest.where("u <> m").select("u", F.col("m").alias("v"))
        following = stage(small.unionByName(own).distinct(), "edges")
        unstage(minima, starred, nearest, current)
        current, before = following, state
        state = _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
