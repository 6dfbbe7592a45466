"""Connected components of a graph that only fits the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources.shared import cut


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """links (a long, b long) as (v, label): every vertex with the smallest vertex of its component.

    Each round takes the least label among a vertex and its neighbours (a partial aggregation, so hubs
    are combined before they are shuffled) and then the label of its label, which halves the way left; rounds follow
    the logarithm of the longest path. Each round is cut.
    """
    both = cut(links.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.filter("a <> b").select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct())
    labels = cut(both.groupBy("v").agg(F.min("u").alias("near")).select("v", F.least("v", "near").alias("label")))
    for _ in range(most):
        near = both.join(labels.select(F.col("v").alias("u"), "label"), "u").groupBy("v").agg(F.min("label").alias("near"))
        lower = labels.join(near, "v").select("v", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        # A label is a vertex; where it has a lower label by now, that one is taken.
        jumped = lower.join(labels.select(F.col("v").alias("label"), F.col("label").alias("next")), "label", "left")
        after = cut(jumped.select("v", F.least("label", F.coalesce("next", "label")).alias("label"), "old"))
        labels = after.select("v", "label")
        if after.filter("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most} rounds")
