"""Connected components of a graph of long ids, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b): the root is the least id of a component.

    Large-star and small-star rounds: each replaces edges by edges to smaller neighbours, until
    all edges are stars. Rounds grow with the logarithm of the size. The least neighbour of a
    node is combined before it is shuffled and written down before it is joined with the edges, so
    that both sides of the join are plain shuffles and a node of any degree is split like any
    skewed join key. Every round is written down.
    """
    edges = settled(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settled(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b") \
            .where("a <> b").distinct()
        # Now b > a everywhere, and the smaller neighbours of b are the a.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")) \
            .union(least.select(F.col("m").alias("a"), "b")).where("a <> b").distinct()
        edges = settled(small, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                    .first())
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")) \
        .union(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
