"""Connected components of a graph given as memberships, by rounds of smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.store import drop_staged, stage


def components(members: DataFrame, node: str, hub: str) -> DataFrame:
    """(node, label) for ``members`` (node, hub): nodes of one hub are connected; the label is the
    smallest node of the component.

    Every round gives each hub the smallest label of its nodes, each node the smallest of its hubs, and
    then the label of that label, so long chains halve. Sums are combined before each shuffle and
    every round is a written table; only the number of changes reaches the driver.
    """
    members = stage(members.select(F.col(node).alias("node"), F.col(hub).alias("hub")), "members")
    labels = last = stage(members.groupBy("node").agg(F.min("node").alias("label")), "labels")
    while True:
        hubs = members.join(labels, "node").groupBy("hub").agg(F.min("label").alias("least"))
        found = members.join(hubs, "hub").groupBy("node").agg(F.min("least").alias("least"))
        nearer = stage(found.join(labels, "node").withColumnRenamed("label", "old"), "nearer")
        further = nearer.select(F.col("node").alias("least"), F.col("least").alias("further"))
        both = nearer.join(further, "least", "left")
        jumped = both.select("node", F.least("least", F.coalesce("further", "least")).alias("label"), "old")
        jumped = stage(jumped, "labels")
        labels = jumped.select("node", "label")
        drop_staged(nearer, last)
        last = jumped
        if not jumped.where("label <> old").limit(1).count():
            drop_staged(members)
            return labels
