"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arealytics.session import pin


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); a component is named by
    its smallest node.

    Every round hangs the larger neighbours of a node, and then the smaller
    ones, under the smallest node in sight (alternating large and small stars),
    which keeps the edge count from growing and needs few rounds.  Each round is
    written to the shared folder.
    """
    current = pin(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct()
    )
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: a node, its smaller neighbours and itself under the smallest
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        under = large.join(small_least, "u")
        small = (
            under.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small_least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        following = pin(small)
        changed = following.exceptAll(current).limit(1).count() + (
            following.count() != current.count()
        )
        current = following
        if not changed:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
