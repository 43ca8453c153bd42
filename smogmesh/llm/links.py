"""Smallest node reachable by links, for graphs of any shape and size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogmesh.llm.common import tidily_written as written


def smallest_reachable(
    nodes: DataFrame, links: DataFrame, *, node: str, a: str, b: str, label: str
) -> DataFrame:
    """``node, label`` for every node: the smallest node reachable over ``links`` (a, b).

    Edges are contracted: in each round every node points to the smallest of
    itself and its neighbours, pointers are followed until they reach a node
    that points to itself, and the edges between the roots found are the next
    round's graph.  Rounds shrink the graph by at least half of its connected
    nodes.  Minima are partial aggregates, so a hub costs one row per task;
    joins read written tables on both sides, so a hub's rows are split.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = written(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        point = written(low.select(F.col("u").alias("x"), F.least("u", "m").alias("to")), "links-point")
        while True:  # pointers fall strictly, so they end at roots; each pass doubles their reach
            hop = point.select(F.col("x").alias("to"), F.col("to").alias("to2"))
            nxt = written(point.join(hop, "to").select("x", F.col("to2").alias("to"), (F.col("to") != F.col("to2")).alias("moved")), "links-point")
            done = nxt.filter("moved").isEmpty()
            point = nxt.select("x", "to")
            if done:
                break
        steps.append(point)
        p = point.select(F.col("x").alias("u"), F.col("to").alias("ru"))
        q = point.select(F.col("x").alias("v"), F.col("to").alias("rv"))
        moved = edges.join(p, "u").join(q, "v").select("ru", "rv").filter("ru <> rv")
        edges = written(moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "links")
    out = nodes.select(F.col(node).alias("x")).distinct().withColumn("to", F.col("x"))
    for point in steps:
        nxt = point.select(F.col("x").alias("to"), F.col("to").alias("_to2"))
        out = out.join(nxt, "to", "left").select("x", F.coalesce("_to2", "to").alias("to"))
    return out.select(F.col("x").alias(node), F.col("to").alias(label))
