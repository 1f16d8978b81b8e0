"""Connected components of a distributed edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge; the root is the least node of its component.

    Each round joins every node's larger neighbours, then its smaller ones, to its least neighbour. The
    edges then form stars after a number of rounds that grows with the logarithm of the size. Least
    neighbours are combined before the shuffle and written: Spark splits a hub's edges only where both sides of
    the join come straight from a shuffle. Edges are written to the shared folder each round; nothing but two numbers reaches the driver. Loops and
    NULL ends are ignored; an empty list gives an empty result.
    """
    pairs = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col("u").isNotNull() & (F.col("u") != F.col("v")) & edges[a].isNotNull() & edges[b].isNotNull())
        .distinct()
    )
    pairs = written(pairs, "edges")
    state = _state(pairs)
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges")  # read twice below
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u != v")
            .distinct()
        )
        pairs = written(small, "edges")
        before, state = state, _state(pairs)
        if state == before:
            nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"no stable components after {max_rounds} rounds")


def _state(pairs: DataFrame) -> tuple:
    """Row count and an order-free digest of the edges."""
    low = F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1))
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(low.cast("decimal(38,0)"))).first())
