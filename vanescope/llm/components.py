"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanescope.llm.stored import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the smallest node it reaches.

    Large-star and small-star steps in turn: each node hands its neighbours to the smallest of
    them until every edge leads to a root. A step is a minimum per node, with partial sums, and
    a join, so a node with very many edges is never gathered; the number of edges never grows
    and the number of rounds is about the logarithm of the longest path. Each round is written
    to shared storage. NULL nodes and loops are dropped.
    """
    current = stored(
        edges.selectExpr("greatest(a, b) AS v", "least(a, b) AS u").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        # Large star: neighbours above a node move to the smallest node it knows.
        both = current.select("v", "u").union(current.select(F.col("u").alias("v"), F.col("v").alias("u")))
        smallest = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(smallest, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: neighbours below a node, and the node, move to the smallest of them.
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(lowest, "v").where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        current = stored(moved.union(lowest.select("v", F.col("m").alias("u"))).distinct(), "edges")
        after = _state(current)
        if after == state:
            break
        state = after
    return current.select(F.col("v").alias("node"), F.col("u").alias("root")).union(current.select("u", "u").distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum over them."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return row[0], row[1]
