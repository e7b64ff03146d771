"""Connected components of an edge table by minimum labels, hooking and pointer jumping, over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """edges: a, b (long; in any direction, repeats allowed). Returns node, label: the smallest node of its component.

    Each round a node takes the smallest label among its own and its neighbours', then the label of its label. Labels
    only fall, so the sum of changes tells the end; long chains halve with each jump. No edges give no rows."""
    edges = edges.where(F.col("a") != F.col("b"))
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        # A root that a member's neighbour undercuts hooks below it: the smaller label also goes to the member's root.
        met = labels.join(near.select(F.col("a").alias("node"), "near"), "node")
        hooks = met.where(F.col("near") < F.col("label")).groupBy(F.col("label").alias("node")).agg(F.min("near").alias("hook"))
        low = met.join(hooks, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "near", "hook").alias("label"))
        low = written(low, "hooked")
        up = low.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = written(low.join(up, "label", "left").select("node", F.least("label", F.coalesce("up", "label")).alias("label"), "old"), "labels")
        if not jumped.where(F.col("label") != F.col("old")).limit(1).count():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
