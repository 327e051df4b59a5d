"""Connected components by least labels with pointer jumping, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import materialize


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex that each vertex of the undirected edges (a, b) reaches.

    A round takes the least label of all neighbours, then the label of that label, so a path of
    n vertices needs about log n rounds. A vertex with very many edges costs no more: joins on it
    split by size and the least label is combined before the shuffle. No edges, no rows.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct()
    both = materialize(both, "edges")
    labels = both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "v")
    labels = materialize(labels, "labels")
    while True:
        near = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["v"] == near["a"], "left").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = materialize(step, "labels")
        far = step.select(F.col("v").alias("to"), F.col("label").alias("far"))
        jumped = step.join(far, step["label"] == far["to"], "left").select("v", "old", F.least("label", "far").alias("label"))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("v", "label")
        if jumped.filter("label < old").isEmpty():
            return labels
