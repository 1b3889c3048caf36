"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caderneta.llm.tables import stored


def relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges (a, b) between the labels of their ends; nodes without a label keep their own."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("label").alias("_to"))
        edges = edges.join(own, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return edges.filter("a <> b").distinct()


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b), both longs; the label is a node.

    ``labels`` of an earlier call are carried on.  In each round every label takes its
    least neighbour, if less than itself, as parent, all labels move up two steps, and
    only edges between different labels remain; rounds grow with the logarithm of the
    longest path.  Self-edges and repeated edges do no harm.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).filter("node IS NOT NULL")
    fresh = nodes.distinct().withColumn("label", F.col("node"))
    if labels is None:
        labels = fresh
        left = edges.filter("a <> b").distinct()
    else:
        left = relabelled(edges, labels)
        labels = labels.unionByName(fresh.join(labels, "node", "left_anti"))
    while True:
        left = stored(left, "edges")
        if left.isEmpty():
            return stored(labels, "labels")
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        parent = stored(parent.select("node", F.least("node", "b").alias("parent")), "parents")
        above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("label"))
        moved = parent.join(above, "parent").select("node", "label")
        up = moved.select(F.col("node").alias("label"), F.col("label").alias("_to"))
        labels = stored(
            labels.join(up, "label", "left").select("node", F.coalesce("_to", "label").alias("label")),
            "labels",
        )
        left = relabelled(left, moved)
