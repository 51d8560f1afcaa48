"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, label): every node that has a link, with the smallest node it can reach.

    ``links`` holds (a, b) in either direction, once or more often. Labels spread along
    links and then jump to the label of their label, so the rounds grow with the logarithm
    of the longest path. No links, no rows. A node with very many links is folded
    map-side before the shuffle.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.where(F.col("a") != F.col("b")).distinct())
    labels = cut_lineage(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("label")
        )
    )
    while True:
        heard = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("heard"))
        spread = labels.join(heard, labels.node == heard.a).select(
            "node", F.col("label").alias("was"), F.least("label", "heard").alias("label")
        )
        spread = cut_lineage(spread)
        jump = spread.select(F.col("node").alias("goal"), F.col("label").alias("far"))
        labels = cut_lineage(
            spread.join(jump, spread["label"] == jump["goal"]).select(
                "node", "was", F.least("label", "far").alias("label")
            )
        )
        if labels.where(F.col("label") != F.col("was")).isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
