"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameharbor.session import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node that can be reached) for each node of the links ``a, b``.

    Every round takes the smallest label of the neighbours and then that label's own label, so the
    rounds grow with the logarithm of the longest path. Labels are written each round.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        closer = labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = written(closer.join(jump, "component", "left").select("node", "old", F.coalesce(F.least("component", "next"), "component").alias("component")), "labels")
        labels = moved.drop("old")
        if moved.filter("component <> old").isEmpty():
            return labels
