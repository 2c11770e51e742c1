"""Connected components of a links table, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every id in ``links(a, b)``; the component is
    its smallest id. Every round takes the least label among the neighbours and
    then the label of that label (pointer jumping), so long chains shorten by
    half a round. Labels and links stay in the cluster."""
    edges = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a IS NOT NULL AND b IS NOT NULL").distinct()
    )
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("component")))
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        )
        step = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        new = materialize(step.join(jump, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("next", "component")).alias("component")))
        changed = new.where("old <> component").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
