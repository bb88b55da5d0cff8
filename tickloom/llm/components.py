"""Connected components of a table of links, by least labels and pointer jumping. Nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in links (a, b); root is the component's least node.

    Each pass gives a node the least label around it and then its label's label; the passes end when a pass changes
    nothing, after about the logarithm of the longest path. A hot node's links are joined by a join that Spark splits.
    """
    both = staged(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "links")
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(near, labels.node == near.a, "left").select("node", F.least("root", F.coalesce("near", "root")).alias("next"), F.col("root").alias("was"))
        jump = lower.join(labels.select(F.col("node").alias("at"), F.col("root").alias("further")), F.col("next") == F.col("at"), "left")
        step = staged(jump.select("node", F.least("next", F.coalesce("further", "next")).alias("root"), "was"), "labels")
        if step.where("root <> was").isEmpty():
            return step.select("node", "root")
        labels = step.select("node", "root")
