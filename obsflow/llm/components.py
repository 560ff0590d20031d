"""Connected components of links between nodes by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.scratch import materialise


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: tie each node's neighbours (the larger or the smaller ones) to the smallest of them and itself."""
    if large:
        both = links.union(links.select("b", "a"))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = both.join(least, "a")
    if large:
        return tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    self_tie = least.where("a <> m").select("a", F.col("m").alias("b"))
    return tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(self_tie).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. Links: a, b (long).

    Alternates large stars and small stars until nothing changes, which takes a number
    of rounds that grows with the logarithm of the longest path. Each round is
    written to a table, so a lost executor costs one round.
    """
    now = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = None
    while True:
        now = materialise(_star(_star(now, large=True), large=False), "links")
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if seen == mark or seen[0] == seen[2] == 0:
            break
        mark = seen
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
