"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them. Here u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u")
        .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        .where("u != v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node that can be reached, for each node with an edge.

    ``edges`` has two BIGINT columns ``u`` and ``v``; loops and repeats are ignored. Alternating
    star steps end after a number of rounds that grows with the logarithm of the longest path.
    Both steps group and join by node with one row a node on one side, so a node with very many
    edges is spread by the skew handling of the join. Each round is cut off by a checkpoint.
    """
    edges = durable(
        edges.where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
        ).first()
        if state["n"] == 0 or (state["n"], state["x"]) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = (state["n"], state["x"])
        edges = durable(_small_star(_large_star(edges)))
