"""Connected components of a graph given as edges, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.checkpoints import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node.

    Every round each node takes the smallest component among its own and its neighbours', and then
    the component of that component, so that chains shorten by half.  A node with very many
    neighbours is reduced to one value per task before it is moved.
    """
    both = checkpointed(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = checkpointed(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("component"))
    )
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("least"))
        stepped = labels.join(seen, labels["node"] == seen["a"], "left").select(
            "node", F.least("component", F.coalesce("least", "component")).alias("near"), F.col("component").alias("was")
        )
        stepped = checkpointed(stepped)
        roots = stepped.select(F.col("node").alias("root"), F.col("near").alias("further"))
        moved = checkpointed(
            stepped.join(roots, stepped["near"] == roots["root"], "left").select(
                "node", F.least("near", F.coalesce("further", "near")).alias("component"), "was"
            )
        )
        if moved.filter("component < was").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")
