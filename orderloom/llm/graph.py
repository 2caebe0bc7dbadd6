"""Connected components by contraction, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import materialize


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that differs from its component's smallest node.

    In each round every node is replaced by the smallest among itself and its neighbours;
    edges inside a merged group vanish. Nodes are longs. Each round's tables are written,
    so lineage stays short; a hub's edges are reduced before the shuffle.
    """
    left = materialize(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "edges")
    found = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).filter("to < node")
        step = materialize(step, "step")
        if found is None:
            found = step.withColumnRenamed("to", "component")
        else:
            onward = step.select(F.col("node").alias("component"), "to")
            moved = found.join(onward, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            found = moved.unionByName(step.withColumnRenamed("to", "component")).dropDuplicates(["node"])
        found = materialize(found, "components")
        for side in "ab":
            to = step.select(F.col("node").alias(side), F.col("to").alias("_to"))
            left = left.join(to, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
        left = materialize(left.filter("a != b").select("a", "b").distinct(), "edges")
    if found is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return _flatten(found)


def _flatten(found: DataFrame) -> DataFrame:
    """Follow components that were merged on until each points to a root."""
    while True:
        onward = found.select(F.col("node").alias("component"), F.col("component").alias("to"))
        moved = found.join(onward, "component", "left")
        if moved.filter("to is not null").isEmpty():
            return found
        found = materialize(moved.select("node", F.coalesce("to", "component").alias("component")), "components")
