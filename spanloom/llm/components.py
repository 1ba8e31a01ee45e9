"""Connected components by alternating large-star and small-star rounds, all in DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.plans.lineage import cut


def _star(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """(v, m): every edge's far end joined to the smallest label around its near end ``u``."""
    return edges.join(minima, "u")


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of an undirected edge list; component is the smallest node of the component.

    The hub's minimum is an aggregate with map-side combining and is joined back to the hub's edges, so a node with a
    third of all edges is never gathered into one task (adaptive execution splits the join's hot partition).  Each round
    is checkpointed.  Self-loops, repeated edges and null ends are ignored; no edges give no rows.  Raises if the rounds
    do not settle (they are logarithmic in the longest path).
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _star(both.where("v > u"), around).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, below).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(below.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == now:
            roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
