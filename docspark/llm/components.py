"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (larger ones, or smaller ones and itself) are tied to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = both.join(least, "a")
    out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the least node of the component of every node that has an edge.

    Every step is an aggregate and a join; only two numbers per round come to
    the driver.  Self-edges, repeated edges and an empty list are allowed.
    """
    now = materialise(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    )
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        now = materialise(_star(_star(now, True), False))
    # A forest of stars: every node is tied to its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
