"""Connected components of an edge table, distributed.

Each round, every node points to its least neighbour (or itself), pointers are doubled until they reach a root, and edges are
contracted to roots; rounds end when no edge is left. Labels are the least ids. A hub's edges are pre-aggregated
map-side, and joins on a hub are plain shuffles that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: long columns a, b. Returns node, component for all nodes that have an edge to another one."""
    edges = stage_table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    total = None
    while edges.limit(1).count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stage_table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "pointers")
        while True:
            again = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            new = stage_table(up.join(again, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "pointers")
            up = new.select("node", "root")
            if not new.where("moved").limit(1).count():
                break
        ends = edges.join(up.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(up.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        edges = stage_table(ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if total is None:
            total = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            total = total.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    if total is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stage_table(total.select("node", F.col("root").alias("component")), "components")
