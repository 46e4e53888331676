"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smudgelex.llm.common import materialized


def connected(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``(node, label)`` for the nodes of ``edges (a, b)``; a label is the smallest
    node of its component.

    ``labels`` are components already known, which the edges may join. Every round
    takes the smallest label among the neighbours and then the label of that label, so
    the number of rounds is about the logarithm of the longest chain; each round is
    written out once, and no node or edge passes through the driver. Labels are final
    when both ends of every edge have the same: stars need one round.
    """
    there = edges.select("a", "b").where("a != b")
    if labels is not None:
        there = there.union(labels.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b")))
    both = there.union(there.select("b", "a"))
    near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    # The first labels are not stored by themselves, only what a round makes of them.
    now = near.select("node", F.least("node", "near").alias("label"))
    while True:
        heard = both.join(now.withColumnsRenamed({"node": "b", "label": "said"}), "b")
        best = heard.groupBy(F.col("a").alias("node")).agg(F.min("said").alias("said"))
        step = now.join(best, "node").select("node", F.least("label", "said").alias("label"))
        jump = now.select(F.col("node").alias("label"), F.col("label").alias("root"))
        now = materialized(step.join(jump, "label").select("node", F.least("label", "root").alias("label")))
        ends = there.join(now.withColumnsRenamed({"node": "a", "label": "left"}), "a")
        ends = ends.join(now.withColumnsRenamed({"node": "b", "label": "right"}), "b")
        if ends.where("left != right").isEmpty():
            return now
