"""Connected components by alternating stars, for graphs of any shape and size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keep = Callable[[DataFrame, str], DataFrame]


def _large_star(edges: DataFrame, keep: Keep) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame, keep: Keep) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = keep(down.groupBy("a").agg(F.min("b").alias("least")), "least")
    rest = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return rest.union(least.select("a", F.col("least").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.max("a")).first()
    return tuple(row)


def components(edges: DataFrame, keep: Keep) -> DataFrame:
    """``node, component`` for every node of the undirected ``edges (a, b)``.

    The component is its smallest node. A hot node costs one partial minimum per task. The minima
    are written by ``keep`` before they are joined back, so the join shuffles a hot node's edges
    anew and Spark can split them. Each round is written too, so lineage stays short. Ends when a
    round changes nothing; rounds follow the logarithm of the longest path.
    """
    edges = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        large = keep(_large_star(edges, keep), "stars")
        edges = keep(_small_star(large, keep), "edges")
        now = _signature(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
