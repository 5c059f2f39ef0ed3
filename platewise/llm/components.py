"""Connected components of a graph whose edges and labels stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.llm.common import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b of one orderable type).

    Each round a node takes the smallest label among its own and its neighbours', then the label of that
    label, so that long chains halve; rounds end when nothing changes. Labels are written to the shared
    folder each round, which cuts the lineage. Nulls and loops take no part; repeated edges do no harm. A
    node with very many neighbours is pre-aggregated in the map tasks, and its joins are split at run time.
    """
    edges = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("component")), "labels")
    stored = labels
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "component", F.least("component", "near").alias("lower"))
        roots = labels.select(F.col("node").alias("root"), F.col("component").alias("above"))
        step = materialize(lower.join(roots, F.col("lower") == F.col("root"), "left").select(
            "node", "component", F.least("lower", F.coalesce("above", "lower")).alias("next")), "labels")
        moved = not step.where("next <> component").limit(1).isEmpty()
        discard(stored)
        labels, stored = step.select("node", F.col("next").alias("component")), step
        if not moved:
            discard(both)
            return labels
