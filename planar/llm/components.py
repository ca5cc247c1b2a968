"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _signature(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge: root is the smallest node
    reachable.  Loops are ignored, an empty edge table gives no rows.

    Each round links every larger neighbour of a node to the smallest one
    (large star), then every smaller neighbour (small star), until the edge
    set no longer changes: every edge then points at its root.  The number of
    rounds grows with the logarithm of the longest chain.  Minima combine on
    the map side; the joins that carry them back are plain shuffled joins,
    whose hot keys adaptive execution splits.  Every round is cut off with
    ``checkpoint()`` in the shared folder, so a lost executor costs one round.
    """
    e = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
        .checkpoint()
    )
    seen = _signature(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = small.checkpoint()
        now = _signature(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
