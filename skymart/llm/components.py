"""Connected components by smallest label, as joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for all nodes of ``edges`` (a, b).

    Each round takes the smallest label of the neighbours and then that label's own label, so long
    chains halve. Ends when a round changes nothing. Every round is a written table.
    """
    both = keep(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "edges"
    )
    labels = keep(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("least"))
        next_ = labels.join(least, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "least").alias("label")
        )
        own = labels.select(F.col("node").alias("label"), F.col("component").alias("further"))
        labels_next = keep(
            next_.join(own, "label").select(
                "node", "old", F.least("label", "further").alias("component")
            ),
            "labels",
        )
        if labels_next.filter("old <> component").isEmpty():
            return labels_next.select("node", "component")
        labels = labels_next.select("node", "component")
