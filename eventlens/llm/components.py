"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, label`` of every node of ``edges`` (``a``, ``b``); the label is
    the smallest node of the component.

    Each round takes the smallest label among a node's neighbours and then the
    label's own label, so long chains shorten by half; only a count of changes
    reaches the driver.  Hub nodes are aggregated map-side.  No edges, no rows.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "cc-labels")
    for _ in range(max_rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        step = stored(lower.join(up, F.col("label") == F.col("up"), "left").select("node", "old", F.least("label", "up_label").alias("label")), "cc-labels")
        labels = step.select("node", "label")
        if step.where("label != old").isEmpty():
            return labels
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
