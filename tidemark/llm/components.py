"""Connected components of a link table by label passing and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """Node and the smallest node of its component, for every node of links(a, b).

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label; rounds grow with the logarithm of a component's
    width. Labels are kept in the shared folder between rounds, so a lost
    executor costs one round. A node with very many links is a skewed equi-join
    under a partial aggregation.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")).checkpoint()
    while True:
        heard = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_heard"))
        lower = labels.join(heard, "node").select("node", F.col("label").alias("_was"), F.least("label", "_heard").alias("label"))
        jumps = lower.select(F.col("node").alias("_at"), F.col("label").alias("_next"))
        after = lower.join(jumps, F.col("label") == F.col("_at")).select("node", "_was", F.least("label", "_next").alias("label")).checkpoint()
        labels = after.select("node", "label")
        if after.filter("label <> _was").isEmpty():
            return labels
