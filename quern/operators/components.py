"""Connected components by alternating large-star and small-star steps.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: Connected Components in
MapReduce and Beyond (2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.store import materialize


def _linked_to_minimum(arcs: DataFrame) -> DataFrame:
    """(u, v, m): each arc with the least of u and all its v's.

    The minimum is pre-aggregated and joined back, so a node with very many
    neighbours is never gathered: the join may split it.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("k"), F.least("k", "low").alias("m"))
    return arcs.join(least, arcs.u == least.k).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _linked_to_minimum(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    arcs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    linked = _linked_to_minimum(arcs)
    return linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(linked.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: long).

    ``component`` is the least node reachable.  Self-loops and nulls count as no
    edge; an empty input gives no rows.  The number of steps grows with the
    logarithm of the components' sizes; each writes the edges in the shared
    folder, so that lineage stays short.
    """
    edges = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "edges")
    state = None
    for _ in range(rounds):
        stepped = _small_star(_large_star(edges)).where("a <> b").distinct()
        edges = materialize(stepped, "stars")
        said = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first()
        if tuple(said) == state:
            break
        state = tuple(said)
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
