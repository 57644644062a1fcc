"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from tallyforge.session import checkpointed


def _ranked(column: str) -> F.Column:
    return F.struct(F.xxhash64(column).alias("rank"), F.col(column).alias("id"))


def _roots(up: DataFrame) -> DataFrame:
    """node and up of a forest, with up replaced by the root of the node's tree."""
    while True:
        above = up.select(F.col("node").alias("same"), F.col("up").alias("far"))
        step = checkpointed(up.join(above, F.col("up") == F.col("same")).select("node", F.col("far").alias("up"), (F.col("far") != F.col("up")).alias("moved")))
        up = step.drop("moved")
        if step.where("moved").isEmpty():
            return up


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node it reaches) of every node in an edge.

    Each round hooks every node to the neighbour of the lowest random rank, if that is below its
    own, follows these trees to their roots, and goes on with the graph of the roots, whose edges
    are fewer each time: with random ranks a fixed share of the nodes goes away, whatever the
    shape, and trees are shallow. All tables are written and read again. A node with very many
    edges is pre-aggregated before its shuffle.
    """
    spark, rounds = edges.sparkSession, []
    graph = checkpointed(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct())
    while not graph.isEmpty():
        both = graph.select(F.col("a").alias("node"), F.col("b").alias("other")).union(graph.select("b", "a"))
        low = both.groupBy("node").agg(F.min(_ranked("other")).alias("low"))
        roots = _roots(checkpointed(low.select("node", F.least("low", _ranked("node"))["id"].alias("up"))))
        rounds.append(roots)
        end = lambda c: roots.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}"))
        left = graph.join(end("a"), "a").join(end("b"), "b").where("up_a <> up_b")
        graph = checkpointed(left.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct())
    if not rounds:
        return spark.createDataFrame([], "node bigint, component bigint")
    found = rounds[-1]
    for step in reversed(rounds[:-1]):
        last = found.select(F.col("node").alias("same"), F.col("up").alias("far"))
        found = step.join(last, F.col("up") == F.col("same"), "left").select("node", F.coalesce("far", "up").alias("up"))
    found = checkpointed(found)
    names = found.groupBy("up").agg(F.min("node").alias("component"))
    return checkpointed(found.join(names, "up").select("node", "component"))


def more_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (the result of ``components``) after further edges (a, b): only the graph of
    the components that they link is worked on."""
    known = labels.select(F.col("node").alias("same"), F.col("component").alias("own"))
    ends = edges
    for c in "ab":
        ends = ends.join(known, F.col(c) == F.col("same"), "left").withColumn(f"in_{c}", F.coalesce("own", c)).drop("same", "own")
    ends = checkpointed(ends)
    merged = components(ends, "in_a", "in_b").select(F.col("node").alias("was"), F.col("component").alias("now"))
    nodes = labels.unionByName(ends.select(F.col("a").alias("node"), F.col("in_a").alias("component")).union(ends.select("b", "in_b"))).distinct()
    return checkpointed(nodes.join(merged, F.col("component") == F.col("was"), "left").select("node", F.coalesce("now", "component").alias("component")))
