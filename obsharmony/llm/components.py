"""Connected components of links, kept distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of links (a, b).

    Each round a node takes the smallest label among its own, its neighbours' and the label of
    its label, so labels jump along chains; rounds end when nothing changes.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    edges = kept(both, "links")
    labels = kept(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        new = labels.join(near, "node").join(jump, "component", "left")
        least = F.least("component", "near", F.coalesce("jump", "component"))
        new = kept(new.select("node", least.alias("component"), (least < F.col("component")).alias("changed")), "labels")
        labels = new.select("node", "component")
        if new.where("changed").isEmpty():
            return labels
