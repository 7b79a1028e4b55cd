"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.scratch import write_table


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (columns a, b of one orderable type); root is the smallest node.

    Alternating large-star and small-star steps: each node links its larger neighbours, then its smaller ones, to the
    smallest node it knows, until nothing changes. The number of rounds grows with the logarithm of a component's size.
    Every round is a table in the shared folder, so a lost executor costs one round's tasks. Loops and nulls are ignored.
    """
    edges = write_table(_ordered(links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: every neighbour above a node goes to the smallest of the node and its neighbours.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _ordered(large.where("a <> b"))
        # Small star: a is below b here; a node and all below it go to the smallest.
        below = large.select(F.col("a").alias("s"), F.col("b").alias("l"))
        smallest = below.groupBy("l").agg(F.min("s").alias("m"))
        moved = below.join(smallest, "l").select(F.explode(F.array("s", "l")).alias("x"), "m").where("x <> m")
        edges = write_table(_ordered(moved.select(F.col("x").alias("a"), F.col("m").alias("b"))), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
