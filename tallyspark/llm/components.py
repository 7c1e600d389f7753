"""Connected components by alternating large and small stars.

Edges shrink towards stars whose hub is the smallest node. Each round is two
aggregations with map-side combine and two equality joins, so a hub with a third
of all edges is never gathered in one task; rounds are written to the shared
folder, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Saved


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """edges: (a, b) with a > b. Points nodes at the least node of their neighbourhood."""
    arcs = edges
    if both_ways:
        arcs = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
    least = arcs.groupBy("a").agg(F.min("b").alias("m"))
    if both_ways:
        least = least.withColumn("m", F.least("a", "m"))
    joined = arcs.join(least, "a")
    if both_ways:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b")
    return moved.filter("a > b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b, longs): root is the component's least node.

    Nulls and loops are no edges; repeated edges count once; no edges give an
    empty result.
    """
    tidy = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    tidy = tidy.filter("a > b").distinct()
    now = Saved(tidy, "edges")
    state = None
    for _ in range(max_rounds):
        nxt = Saved(_star(_star(now.df, True), False), "edges")
        now.remove()
        now = nxt
        seen = now.df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    roots = now.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.df.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
