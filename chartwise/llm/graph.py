"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that links reach.

    Each round points a node to the least node among its neighbours and itself, then a label to that label's own label;
    a stored table a round cuts the lineage.  Minima are partially aggregated, so a node with very many
    links is one row per task.  Ends when a round changes nothing.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    label = stored(both.select("node").distinct().withColumn("component", F.col("node")), "labels")
    while True:
        seen = both.join(label.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("component").alias("least"))
        hop = label.join(seen, "node", "left").select(
            "node", F.col("component").alias("old"), F.least("component", "least").alias("up"))
        # the label of the label: halves the distance that is left
        jump = label.select(F.col("node").alias("up"), F.col("component").alias("top"))
        new = stored(hop.join(jump, "up", "left").select(
            "node", "old", F.least("up", "top").alias("component")), "labels")
        changed = new.where("component != old").limit(1).count()
        label = new.select("node", "component")
        if not changed:
            return label
