"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns node and component (the smallest node reachable) for every node that is not itself the smallest.

    ``edges`` has two columns of one type, in any direction, repeated or not; edges with a null are no edges. Large-star
    and small-star steps alternate: neighbours above a node move to the smallest neighbour, then those below it. Each
    step emits at most as many edges as it got, so a hub grows no product. Every round is a table in the shared folder.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, seen = stored(edges, "components"), None
    while True:
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h")
        ).first()
        if state == seen or not state["n"]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        current = stored(_small_star(_large_star(current)), "components")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()
