"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import materialise


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes of ``links`` (a, b).

    Each round links the larger neighbours of a node to its smallest one, then its smaller ones,
    until every node is linked to the smallest of its component alone. A round is two aggregates;
    nothing but whether that is so reaches the driver.
    """

    def stars(edges: DataFrame, larger: bool) -> DataFrame:
        """Link neighbours of each node to the smallest of the node and its neighbours."""
        if larger:
            both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = edges
        smallest = both.groupBy("a").agg(F.min("b").alias("low")).select(
            "a", F.least("a", "low").alias("low")
        )
        met = both.join(smallest, "a")
        if larger:
            return met.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        moved = met.select(F.col("b").alias("a"), F.col("low").alias("b"))
        own = smallest.select("a", F.col("low").alias("b"))
        return moved.unionByName(own).filter("a != b").distinct()

    def settled(edges: DataFrame) -> bool:
        """Whether each node has one smaller neighbour at most, and none if it has larger ones."""
        sides = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        sides = sides.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        of_node = sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return of_node.filter("up > 1 OR up > 0 AND down > 0").isEmpty()

    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    edges = materialise(edges.distinct(), "components")
    while not settled(edges):
        edges = materialise(stars(stars(edges, True), False), "components")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
