"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for the nodes of ``edges`` (a, b).

    In each round a node takes the smallest label among its neighbours, then the label
    of its label, until nothing changes. Labels and edges are written tables, so a hot
    node is a skewed join, which adaptive execution splits, and a partial minimum.
    Rounds grow with the logarithm of the longest chain, about. Repeated edges and
    loops do no harm; no edges give no rows.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("least"))
        moved = stored(labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "least").alias("label"), F.col("label").alias("old")), "labels")
        above = moved.select(F.col("node").alias("at"), F.col("label").alias("above"))
        jumped = stored(moved.join(above, F.col("label") == F.col("at")).select("node", F.least("label", "above").alias("label"), "old"), "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels
