"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (combined map-side, so hubs are no burden)
and a join back to the edges, whose hot keys AQE can split. The edge list is
checkpointed once a round; the number of rounds is logarithmic in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Edges point from the larger end ``a`` to the smaller ``b``."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a")
    out = moved.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b long) -> (node, component): the smallest node reachable, for nodes with an edge."""
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        e = stored(_small_star(_large_star(e)))
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
