"""Connected components by alternating stars, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge list; the component is its smallest node.

    Each round moves every node to smaller neighbours (large star, then small star) and ends when
    nothing changes, after a number of rounds that grows with the logarithm of the longest path.
    An empty edge list gives an empty result; loops and repeated edges do no harm.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("p")).where("u <> p").distinct()
    pairs = cut(pairs, "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("p").alias("u"), F.col("u").alias("p")))
        least = both.groupBy("u").agg(F.least(F.min("p"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("p > u").select(F.col("p").alias("u"), F.col("m").alias("p")).where("u <> p").distinct()
        parent = large.groupBy("u").agg(F.min("p").alias("m"))
        joined = large.join(parent, "u")
        small = joined.select("u", F.col("m").alias("p")).unionByName(joined.where("p <> m").select(F.col("p").alias("u"), F.col("m").alias("p"))).distinct()
        pairs = cut(small, "edges")
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "p").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    nodes = pairs.groupBy("u").agg(F.min("p").alias("component"))
    roots = nodes.select(F.col("component").alias("node")).distinct()
    return nodes.select(F.col("u").alias("node"), "component").unionByName(roots.select("node", F.col("node").alias("component")))
