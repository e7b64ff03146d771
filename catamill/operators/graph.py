"""Connected components by minimum labels and pointer jumping; lineage is cut in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.session import cut


def components(edges: DataFrame) -> DataFrame:
    """edges a, b. Returns node, label (smallest node of its component) of all nodes that edges name."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = low.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = cut(low.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")))
        labels = jumped.select("node", "label")
        if not jumped.where("label <> old").limit(1).count():
            return labels
