"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, label): the smallest node each can reach.

    Every round takes the smallest label among the neighbours and then
    follows that label's own label, so the rounds grow with the logarithm
    of the longest path. Each round is written to the shared folder, which
    cuts the lineage; the driver only learns whether a label changed.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionAll(both.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = materialize(both.where("node <> other").distinct(), "edges")
    first = both.groupBy("node").agg(F.min("other").alias("m"))
    labels = materialize(first.select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        near = both.join(theirs, "other").groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("via")
        )
        far = labels.select(F.col("node").alias("via"), "label")
        labels = materialize(step.join(far, "via").select("node", "label", "before"), "labels")
        if labels.where("label <> before").isEmpty():
            return labels.select("node", "label")
        labels = labels.drop("before")
