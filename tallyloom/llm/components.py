"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u > v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an undirected edge list; component is the smallest node reachable.

    Nodes are 64-bit integers. Self-loops, repeated edges and edges with a null end are ignored, and an empty edge list gives an
    empty result. Every round writes its edges to the shared folder, so lineage stays one round long; only two numbers a round
    (count and hash sum) reach the driver. Hubs are handled by partial aggregation and by joins that adaptive execution can split.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    e, before = stored(_distinct(e), "edges"), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
        e = stored(_distinct(_small_star(_distinct(_large_star(e)))), "edges", rows=now[0])
