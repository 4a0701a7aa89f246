"""Connected components of a link table, as joins and aggregates.

Every round gives each node the least label among its neighbours and then
follows labels one step (pointer jumping), until nothing changes.  Labels and
links stay in tables of the shared folder; the driver only sees one count a
round.  Joins have plain exchanges on both sides, so Spark can split a node
that holds a third of all links.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, unstore


def connected(links: DataFrame) -> DataFrame:
    """links (a, b) → (node, comp): the least node id reachable, for every node
    that has a link."""
    both = links.select("a", "b").filter("a <> b")
    edges = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
        least = edges.join(of, "b").groupBy("a").agg(F.min("cb").alias("m"))
        near = stored(labels.join(least.withColumnRenamed("a", "node"), "node").select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("old")), "near")
        step = near.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = stored(near.join(step, "comp").select("node", F.col("far").alias("comp"), "old"), "labels")
        changed = new.filter("comp <> old").count()
        unstore(near)
        unstore(labels)
        labels = new.select("node", "comp")
        if not changed:
            unstore(edges)
            return labels
