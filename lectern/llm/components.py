"""Connected components of an edge table, by alternating star contractions on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")), "least")  # Spark can split a join of tables
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of those."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a")
    return moved.select("a", F.col("m").alias("b")).union(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge to another; component is the smallest node reachable.

    ``edges`` has columns a and b of one sortable type. Loops and nulls are left out; an empty table gives
    an empty result. Each round is written to the shared folder, so lineage stays short and a lost executor
    costs one round at most. The tables hold one row an edge and never pass through the driver.
    """
    clean = lambda df: df.where("a <> b").distinct()
    now = written(clean(edges.select("a", "b")), "edges")
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == mark:
            break
        mark = state
        large = written(clean(_large_star(now)), "edges")
        now = written(clean(_small_star(large)), "edges")
    tops = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops.select("node", F.col("node").alias("component")))
