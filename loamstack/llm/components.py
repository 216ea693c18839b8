"""Connected components of links, by minimum labels with pointer jumping, cut at each round by a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.llm.store import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for the nodes of ``links`` (a, b)."""
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        seen = edges.join(labels.withColumnsRenamed({"node": "b", "label": "theirs"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "theirs").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        new = materialise(nearer.join(jump, "near").select("node", "old", F.least("near", "far").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter("label <> old").limit(1).count() == 0:
            return labels
