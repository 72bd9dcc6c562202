"""Connected components of links, without gathering any of them in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a long, b long).

    The component is the smallest node reachable. Rounds alternate two steps: each node
    ties its larger neighbours, then its smaller ones, to the smallest node it knows.
    Links become stars within a few rounds, about the logarithm of the longest path.
    """

    def directed(rows: DataFrame) -> DataFrame:
        return rows.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    current = materialise(directed(links.select("a", "b")).distinct(), "links")
    state = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        wide = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # a node that is the least of its star keeps its links through its neighbours
        wide = directed(wide).distinct()
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        tied = wide.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = tied.union(least.select("a", F.col("m").alias("b")))
        current = materialise(directed(tied).distinct(), "links")
        seen = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if seen == state:
            break
        state = seen
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
