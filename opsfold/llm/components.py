"""Connected components by contraction, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsfold.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` to ``(node, label)`` for all nodes of edges; labels are least nodes.

    Each round gives every node the least of itself and its neighbours and
    replaces edges by edges between these; every node that still has an edge
    merges, so the rounds are few.  Only counts reach the driver.
    """
    edges = edges.filter(F.col("u") != F.col("v"))
    both = stored(edges.union(edges.select("v", "u")).distinct(), "edges")
    labels = None
    while True:
        step = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to")), "labels")
        if labels is None:
            labels = step.select(F.col("u").alias("node"), F.col("to").alias("label"))
        else:
            labels = stored(
                labels.join(step, labels["label"] == step["u"], "left")
                .select("node", F.coalesce("to", "label").alias("label")), "labels")
        a = step.select("u", F.col("to").alias("x"))
        b = step.select(F.col("u").alias("v"), F.col("to").alias("y"))
        both = stored(both.join(a, "u").join(b, "v").filter("x != y")
                      .select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), "edges")
        if both.isEmpty():
            return labels
