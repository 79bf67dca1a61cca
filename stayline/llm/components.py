"""Connected components of a link table: nodes hook to their smallest neighbour, and the links shrink to the roots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import materialise


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for all nodes of ``links`` (a, b); ``root`` is the smallest node of the component.

    Each round hooks every node that still has links to its smallest neighbour, follows the hooks to their end and keeps
    the links between different ends, each once. A node is an end only if all its neighbours are larger, so the linked
    nodes at least halve per round, and a large group of mutual links falls to few in the first. Tables are written once
    a round, which keeps the plan short and survives lost executors; the driver sees one number per round.
    """
    edges = _once_each(links.select("a", "b"))
    labels = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        ends = _followed(both.groupBy("node").agg(F.min("other").alias("least")).select(
            "node", F.least("node", "least").alias("root")))
        if labels is None:
            labels = ends
        else:
            onward = ends.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = materialise(labels.join(onward, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "labels")
        end_of = lambda c: ends.select(F.col("node").alias(c), F.col("root").alias(f"{c}_end"))
        edges = _once_each(edges.join(end_of("a"), "a").join(end_of("b"), "b").select("a_end", "b_end").toDF("a", "b"))
        if edges.isEmpty():
            return labels


def _once_each(links: DataFrame) -> DataFrame:
    """The links between different nodes, smaller node first, each once."""
    ordered = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return materialise(ordered.distinct(), "links")


def _followed(hooks: DataFrame) -> DataFrame:
    """Rows (node, root) with every hook followed to its end: twice as far per round."""
    reached = materialise(hooks.withColumn("moved", F.lit(True)), "labels")
    while not reached.where("moved").isEmpty():
        jump = reached.select(F.col("node").alias("root"), F.col("root").alias("root2"))
        reached = materialise(reached.select("node", "root").join(jump, "root", "left").select(
            "node", F.col("root2").alias("root"), (F.col("root2") != F.col("root")).alias("moved")), "labels")
    return reached.select("node", "root")
