"""Connected components of an edge table, by rounds of joins with written steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larkspur.llm.tables import cut


def roots(parents: DataFrame) -> DataFrame:
    """Follow ``parent`` pointers to their end: (node, root).

    Each node has one row, and a parent is smaller than its node or the node itself.  Pointers
    double in each round, so the rounds grow with the logarithm of the longest chain.
    """
    at = cut(parents.select("node", F.col("parent").alias("root")))
    while True:
        up = at.select(F.col("node").alias("root"), F.col("root").alias("above"))
        at = cut(at.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), (F.coalesce("above", "root") != F.col("root")).alias("moved")))
        if at.where("moved").isEmpty():
            return at.select("node", "root")
        at = at.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node of the edges (a, b): (node, root).

    Alternating stars: each round hangs every node under the smallest label in its neighbourhood, follows
    the pointers to their ends, and carries the edges over to these ends; edges inside one end drop out.
    Labels are joined, never collected.
    """
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("b").alias("node"), F.col("a").alias("parent")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("parent")))
        step = roots(both.groupBy("node").agg(F.min("parent").alias("parent")))
        if labels is None:
            labels = step
        else:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("above"))
            labels = cut(labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")).union(
                step.join(labels.select("node"), "node", "left_anti").select("node", "root")))
        a, b = step.select(F.col("node").alias("a"), F.col("root").alias("ra")), step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = cut(edges.join(a, "a").join(b, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).where("a <> b").distinct())
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
