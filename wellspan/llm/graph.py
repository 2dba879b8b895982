"""Connected components of an edge table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected, materialized ``edges`` (a, b).

    ``component`` is the smallest node reachable.  Each round every node takes the smallest
    label around it and then its label's label, so chains shorten by half; rounds end when
    nothing changes.  All joins are shuffles by node with map-side minima, so a node with
    very many links costs its links once, spread over the tasks that hold them.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        # A label is itself a node: follow it one step.
        targets = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        stepped = materialize(hooked.join(targets, "label", "left").select("node", "was", F.least("label", "further").alias("label")))
        changed = not stepped.where("label <> was").isEmpty()
        labels = stepped.drop("was")
        if not changed:
            return labels.withColumnRenamed("label", "component")
