"""Connected components of an edge table by repeated minimum labels, on written tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from stratline.llm.trie import looked_up

Cut = Callable[[DataFrame, str], DataFrame]


def components(edges: DataFrame, cut: Cut, name: str) -> DataFrame:
    """(node, label): the smallest node of each node's component, for nodes with an edge.

    edges has columns a and b. Every round takes the smallest label around each node and
    then the label of that label, so that long chains halve; a round is a written table."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = cut(both.where("a <> b").distinct(), f"{name}-links")
    labels = cut(links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("far"))
        # A third of all nodes may carry one label: it is looked up once for each label, and
        # labels that many nodes carry by broadcast.
        lookup = cut(nearer.groupBy("least").agg(F.count("*").alias("n")).join(jump, "least"), f"{name}-jump-{turn}")
        best = looked_up(nearer, lookup, ["least"], "n", 1000).select(
            "node", F.least("least", "far").alias("label"), F.col("label").alias("before")
        )
        best = cut(best, f"{name}-{turn}")
        labels = best.select("node", "label")
        if best.where("label <> before").isEmpty():
            return labels
