"""Connected components of a link table, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm.common import shared_table


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, component) for links (u, v) of longs; component is the smallest node
    reachable. Nodes without a link are not in the result.

    Alternating large-star and small-star rounds: minima are combined on the map side
    and joined back, so a hub's links are never gathered, and every round is written to
    the shared folder (or ``folder`` in it). It ends when all links are stars: no node has two links upwards,
    none has links both ways. Null ends and loops are ignored.
    """
    edges = shared_table(links.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                      F.least("u", "v").alias("v")).distinct(), folder=folder)
    while not _stars(edges):
        # large star: larger neighbours move to the smallest neighbour (or the node)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .repartition("u"))
        # small star: smaller neighbours and the node move to the smallest neighbour
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = shared_table(
            large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), folder=folder)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    held = ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    # a node with two links up, or with one up and one down
    return not held.where("up > 1 or (up = 1 and least = 0)").limit(1).count()


def local_roots(n: int, left: list[int], right: list[int]) -> list[int]:
    """Smallest member of the group of each of 0..n-1 under the given links."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in zip(left, right):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
