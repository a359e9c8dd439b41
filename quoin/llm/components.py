"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a long, b long); root is the least node of its component.

    Alternates the two star operations of the map-reduce algorithm: a node's larger neighbours are
    hung on the least node near it, then its smaller ones. Minima are taken with map-side
    aggregation and joined back; no neighbours are gathered in memory, but a hub's edges meet in one
    partition of that join unless Spark splits it. Each round is cut with
    checkpoint(); the rounds grow with the logarithm of the nodes. Loops, repeated edges and
    edges with a null end are harmless; an empty table gives an empty one.
    """

    def star(links: DataFrame) -> DataFrame:
        """links (u, v): every v of u, and u itself, gets an edge to the least of them."""
        least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return links.join(least, "u")

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    nodes = e
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        hung = star(large)
        e = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(hung.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
        now = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == before:
            break
        before = now
    every = nodes.select(F.col("u").alias("node")).unionByName(nodes.select(F.col("v").alias("node"))).distinct()
    return every.join(e.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
