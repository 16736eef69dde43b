"""Connected components of links, by minimum labels and pointer jumping over written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node that it reaches) for each node of edges (columns a and b).

    Each round every node takes the least label among its own and its neighbours', then the label of that; the
    labels are written after each round, so no round depends on executors that ran an earlier one.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"], "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        lower = cut(lower)
        up = lower.select(F.col("node").alias("up"), F.col("low").alias("lowest"))
        jumped = cut(lower.join(up, lower["low"] == up["up"], "left").select("node", "label", F.least("low", F.coalesce("lowest", "low")).alias("new")))
        changed = jumped.where("new <> label").limit(1).count()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
