"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchfold.llm.common import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``; the component is its smallest node.

    First every node is put under its smallest neighbour and edges are drawn between the
    nodes that have others under them; that is a small graph where groups are stars. In
    it each round takes the smallest label among a node's neighbours and then the label
    of that label, so the rounds grow with the logarithm of a component's diameter.
    Labels are combined by a grouped minimum, never collected, so a hub with very
    many links is no hot task. Labels are written to the checkpoint folder each round.
    """
    drawn = materialise(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                        .filter("lo <> hi").distinct())
    under = materialise(drawn.groupBy("hi").agg(F.min("lo").alias("up")))
    heads = drawn.select(F.col("lo").alias("hi")).distinct()
    inner = (drawn.join(under, "hi").select(F.col("lo").alias("node"), F.col("up").alias("other"))
             .union(under.join(heads, "hi", "left_semi").select("up", "hi"))
             .filter("node <> other").distinct())
    labels = _labels(inner)
    nodes = (drawn.select(F.col("lo").alias("node"), F.col("lo").alias("head"))
             .union(under.select("hi", "up")).groupBy("node").agg(F.min("head").alias("head")))
    return (nodes.join(labels.withColumnRenamed("node", "head"), "head", "left")
            .select("node", F.coalesce("label", "head").alias("component")))


def _labels(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (node, other): the smallest node it reaches."""
    both = materialise(edges.union(edges.select("other", "node")).distinct())
    labels = materialise(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("label").alias("near")))
        stepped = (labels.join(near, "node")
                   .select("node", F.col("label").alias("old"),
                           F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        rounds = materialise(
            stepped.join(jump, "label", "left")
            .select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "old"))
        labels = rounds.select("node", "label")
        if rounds.filter("label <> old").isEmpty():
            return labels
