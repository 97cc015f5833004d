"""Connected components by minimum labels and pointer jumping, cut by written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) for every node of edges a, b (long). Null ends are left out.

    Each round takes the smallest label among neighbours and then the label of the label, so that rounds grow with
    the logarithm of the diameter. Labels are pre-aggregated before they are shuffled.
    """
    both = edges.where("a is not null and b is not null")
    both = written(both.select("a", "b").unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("of")).agg(F.min("label").alias("near"))
        low = labels.join(near, labels["node"] == near["of"], "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        up = labels.select(F.col("node").alias("at"), F.col("label").alias("up"))
        new = written(low.join(up, low["low"] == up["at"], "left").select("node", F.least("low", F.coalesce("up", "low")).alias("label"), (F.least("low", F.coalesce("up", "low")) != F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels
