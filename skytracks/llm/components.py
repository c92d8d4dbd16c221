"""Connected components of a table of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytracks.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Large-star and small-star steps in turn: each hangs neighbours on the smallest one known, until nothing
    changes, in a number of rounds that grows with the logarithm of the longest path. Groups are only
    aggregated and joined, never listed. Each round is stored in the shared folder. Repeated links, links of a node to
    itself and an empty table are fine.
    """
    edges = stored(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: larger neighbours of a node go to its smallest neighbour, or to itself.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        large = large.filter("a <> b").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m"), "a", "b")
        small = small.select(F.col("m").alias("a"), "b").unionByName(
            small.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        )
        edges = stored(small.filter("a <> b").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(state):
            break
        mark = tuple(state)
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return nodes.unionByName(roots)
