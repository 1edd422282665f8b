"""Connected components by alternating large and small stars.

Links stay in distributed tables. Each pass hooks neighbours to the least vertex that they see; hubs are safe,
as the rows of a vertex are joined with one row for it, a join whose large partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def redealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt out by a hash of its keys, so that a later join by them shuffles both sides and can split skewed ones."""
    return df.repartition(F.xxhash64(*keys))


def _hook(edges: DataFrame, large: bool) -> DataFrame:
    """One star pass over (u, v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = redealt(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "u")
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every vertex that has an edge to another one; component is the least id it can reach.

    Loops and edges with a null end are ignored, repeated edges count once; no edges give an empty table.
    """
    edges = saved(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        edges = saved(_hook(_hook(edges, True), False))
        # stars are stable: the passes have come to an end when they give the same edges again
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    hubs = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(hubs)
