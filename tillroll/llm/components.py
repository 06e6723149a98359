"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has an edge to another; the component is its smallest node.

    Large-star and small-star rounds: each hangs the neighbours of a node below the smallest one near it, and
    ends when a round changes nothing. Every round combines before its shuffles and is a checkpoint, so neither
    a hub nor a lost executor matters; no edge goes to the driver. Edges with a null end and loops are left out.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = cut(e.where("u is not null and v is not null and u <> v and {0} is not null and {1} is not null".format("u", "v")).distinct())
    before = None
    while True:
        # a round starts from edges that point down (u > v)
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = cut(small.select("x.*").where("u <> v").distinct())
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    top = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = top.select(F.col("component").alias("node"), "component").distinct()
    return top.select(F.col("u").alias("node"), "component").union(roots)
