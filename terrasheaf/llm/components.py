"""Connected components of a table of links, by alternating large and small stars over Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import join_counted, materialize


def stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: each node's neighbours are linked to its smallest neighbour instead, or itself if that is smaller (large: the neighbours
    above the node; small: those below, and the node). Nodes with a large share of all links are joined without a shuffle."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    linked = join_counted(near, materialize(least, "least"), "a", "n")
    if large:
        moved = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
    return moved.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b, of an ordered type): root is the smallest node that can be reached.

    Rows repeated, in either direction or from a node to itself are allowed; nulls must be filtered before; no rows give no rows. Each
    round is written to the shared folder, so the lineage stays short; the number of rounds grows with the logarithm of the longest chain.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(edges.where("a != b").select("a", "b").distinct(), "edges")
    seen = mark(edges)
    while seen[0]:
        edges = materialize(stars(stars(edges, True), False), "edges")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
