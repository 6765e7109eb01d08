"""Connected components of an edge table, by repeated minima over neighbours and label jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of edges (a, b): label is the least node that can be reached.

    Each round takes the least label among a node's neighbours and then the label of that label, so that paths shorten
    by half or more; rounds end when none changes a label. Every round is a written table. No edges give no rows.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
    both = saved(both.where("node <> near").distinct(), "edges")
    labels = saved(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("label")), "labels")
    while True:
        near = labels.select(F.col("node").alias("near"), F.col("label").alias("offer"))
        offers = both.join(near, "near").groupBy("node").agg(F.min("offer").alias("offer"))
        better = labels.join(offers, "node").select("node", F.least("label", "offer").alias("label"), F.col("label").alias("before"))
        better = saved(better, "offers")
        jump = better.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = better.join(jump, "label", "left").select("node", F.coalesce("further", "label").alias("label"), "before")
        after = saved(after, "labels")
        if after.where(F.col("label") != F.col("before")).isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
