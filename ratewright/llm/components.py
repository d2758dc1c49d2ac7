"""Connected components of a table of links, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.storage import materialise

ROUNDS = 100  # far above the logarithm of any number of nodes


def components(links: DataFrame) -> DataFrame:
    """node, label of every node in ``links`` (a, b): label is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours, then the label of its label. Rounds
    end when no label changes; their tables are written, so a round never hangs on the one before.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.where("a <> b").distinct(), "edges")
    labels = edges.groupBy("a").agg(F.min("b").alias("least"))
    labels = materialise(labels.select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels")
    for _ in range(ROUNDS):
        near = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("least"))
            .withColumnRenamed("a", "node")
        )
        nearer = labels.join(near, "node").select("node", "label", F.least("label", "least").alias("next"))
        nearer = materialise(nearer, "nearer")
        jump = nearer.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        moved = nearer.join(jump, "next", "left")
        moved = moved.select("node", F.least("next", "beyond").alias("new"), (F.col("label") != F.least("next", "beyond")).alias("changed"))
        moved = materialise(moved, "labels")
        labels = moved.select("node", F.col("new").alias("label"))
        if moved.where("changed").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {ROUNDS} rounds")
