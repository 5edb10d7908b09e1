"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.llm.tables import store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
            )
        ).alias("e")
    ).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on its smallest neighbour."""
    ways = _both_ways(edges)
    least = ways.groupBy("u").agg(F.min("v").alias("low"))
    return (
        ways.where("v > u")
        .join(least, "u")
        .select(F.least("u", "low").alias("a"), F.col("v").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node, and its smaller neighbours, on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("low"))
    hung = down.join(least, "u").where("v <> low").select(F.col("low").alias("a"), F.col("v").alias("b"))
    return hung.unionByName(least.select(F.col("low").alias("a"), F.col("u").alias("b"))).distinct()


def _digest(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the least node reachable.

    Each round is aggregates and joins on a node, stored before the next, so neither a
    hub nor a large component is ever gathered.  The number of rounds grows with the
    logarithm of the longest chain.  Nodes without an edge to another node are left out;
    null ends make no edge.
    """
    now = store(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = _digest(now)
    while seen[0]:
        now = store(_small_star(_large_star(now)), "stars")
        last, seen = seen, _digest(now)
        if seen == last:
            break
    members = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return members.unionByName(roots)
