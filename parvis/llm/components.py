"""Connected components of an edge table by repeated contraction.

Each round points every node to its smallest neighbour, follows these pointers a few steps,
and replaces the ends of all edges by where they arrive. Pointers lead to smaller ids only, so
the last node left of a component is its smallest. Each round is written to the shared scratch
folder; edges and labels never pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.staging import stage

JUMPS = 2


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; ``component`` is its smallest node.

    Rows with a null end and loops are ignored; an empty table gives an empty result.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stage(nodes.select("node", F.col("node").alias("component")), "labels")
    while not edges.isEmpty():
        down = edges.groupBy("a").agg(F.min("b").alias("to"))
        for k in range(JUMPS):
            down = stage(down, f"pointers{k}")
            on = down.select(F.col("a").alias("via"), F.col("to").alias("further"))
            down = down.join(on, F.col("to") == F.col("via"), "left").select(
                "a", F.coalesce("further", "to").alias("to"))
        down = stage(down, "pointers")
        step = down.select(F.col("a").alias("from_"), "to")
        labels = stage(
            labels.join(step, F.col("component") == F.col("from_"), "left")
            .select("node", F.coalesce("to", "component").alias("component")), "labels")
        for end, other in (("a", "b"), ("b", "a")):
            edges = edges.join(step, F.col(end) == F.col("from_"), "left").select(
                F.coalesce("to", end).alias(end), other)
        edges = stage(
            edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            "edges")
    return labels
