"""Connected components of a graph given as edges, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsweft.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (a, b); comp is the least node reached.

    Large-star and small-star rounds, until an edge list repeats: every node's larger
    neighbours are tied to its least neighbour, then the node and its smaller ones. Basins
    are thus joined at their roots, so a long path takes a logarithmic number of rounds, and there
    is no bound on them. Edges are cut to the shared checkpoint folder each round.
    """
    links = cut_lineage(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut_lineage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        new = cut_lineage(small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        if not new.exceptAll(links).take(1) and not links.exceptAll(new).take(1):
            break
        links = new
    return links.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
