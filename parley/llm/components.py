"""Connected components of a graph of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.session import materialize


def _least(edges: DataFrame, own: bool) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m")) if own else least


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the least node around."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_least(both, True), "u")
        .where("v > u AND v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the least of these."""
    least = _least(edges, False)
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Columns ``node`` and ``root``, the least node of its component, for all nodes with links.

    Alternates between linking larger neighbours and smaller neighbours with the
    least node around, until nothing changes; the number of rounds grows with
    the logarithm of the longest path. Each round is a written table, so a lost
    executor costs one round. The driver sees two numbers a round.
    Null nodes and links of a node with itself are left out.
    """
    u, v = F.col(left), F.col(right)
    edges = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    edges = materialize(edges.where(u.isNotNull() & v.isNotNull() & (F.col("u") > F.col("v"))).distinct(), "links")
    before = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = mark
        edges = materialize(_small_star(_large_star(edges)), "links")
