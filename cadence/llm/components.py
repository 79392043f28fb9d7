"""Connected components by joins: smallest neighbour's label, then pointer jumping, until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import stage


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) of every node in the edges (a, b).

    Labels are written to the shared folder in each round, so a lost executor costs one round. The
    minimum is combined before the shuffle, and joins read staged tables, so a hot node can be split.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = stage(labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("new"), F.col("label").alias("old")), "labels")
        jump = step.select(F.col("node").alias("at"), F.col("new").alias("to"))
        step = stage(step.join(jump, F.col("new") == F.col("at")).select("node", F.col("to").alias("label"), "old"), "labels")
        if step.filter("label < old").isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")
