"""Connected components of a large graph: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlake.llm.shared import Workspace


def components(edges: DataFrame, space: Workspace, name: str = "stars") -> DataFrame:
    """(node, root): the smallest node reachable over `edges` (a long, b long), for all nodes in edges.

    Each round is two aggregations and two joins over the edges, whose number never grows, and ends in
    a table of the shared folder; there are about as many rounds as the logarithm of the longest chain.
    A node with very many neighbours is an aggregation key only for a minimum, which is taken before the
    shuffle as well; its rows are spread by the join's skew handling, as both join inputs are tables.
    Edges of a node to itself and repeated edges do no harm. No edges give no rows.
    """
    current = space.put(
        f"{name}-0",
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
    )
    turn = 0
    while True:
        large = _large_star(current, space, f"{name}-large-{turn}")
        following = space.put(f"{name}-{turn + 1}", _small_star(large, space, f"{name}-small-{turn}"))
        before = _fingerprint(current)
        after = _fingerprint(following)
        for old in (f"{name}-{turn}", f"{name}-large-{turn}", f"{name}-small-{turn}"):
            space.drop(old)
        current, turn = following, turn + 1
        if before == after:
            break
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and in practice for no others."""
    hashed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(hashed.cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame, space: Workspace, name: str) -> DataFrame:
    """Joins each larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = space.put(name, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return (
        both.filter(F.col("v") > F.col("u")).join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame, space: Workspace, name: str) -> DataFrame:
    """Joins each smaller neighbour of a node, and the node, to the smallest of them."""
    least = space.put(name, edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = (
        edges.join(least, "u").filter(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
