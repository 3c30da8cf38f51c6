"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges (a, b: long). Each round is written to the shared folder; the number of rounds grows with the logarithm of the longest path. A node with many edges is only ever aggregated and joined, so Spark can split it."""
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def linked_to_least(e: DataFrame, directed: DataFrame) -> DataFrame:
        """Every neighbour in `directed`, and the node itself, to the least of the node and its neighbours."""
        least = directed.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        near = directed.join(least, "a")
        return near.select(F.col("b").alias("x"), "m", "a")

    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        # large star: the larger neighbours of a node go to its least neighbour
        large = linked_to_least(e, both(e)).filter("x > a").select(F.col("x").alias("a"), F.col("m").alias("b"))
        e = materialize(large.filter("a <> b").distinct(), "edges")
        # small star: a node and its smaller neighbours go to the least of them
        near = linked_to_least(e, e)
        small = near.select(F.col("x").alias("a"), F.col("m").alias("b")).unionByName(near.select("a", F.col("m").alias("b")))
        e = materialize(small.filter("a <> b").distinct(), "edges")
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == (r["n"], r["h"]):
            break
        state = (r["n"], r["h"])
    roots = e.select(F.col("b").alias("node")).distinct().join(e.select(F.col("a").alias("node")), "node", "left_anti")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
