"""Connected components by contraction, as a few small Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir


def _stored(frame: DataFrame) -> DataFrame:
    return materialize(frame, work_dir(frame.sparkSession, "components"))


def _roots(hook: DataFrame) -> DataFrame:
    """(node, up) with up < node, followed to the root by pointer jumping."""
    while True:
        a, b = hook.alias("a"), hook.alias("b")
        jumped = _stored(
            a.join(b, F.col("a.up") == F.col("b.node"), "left").select(
                "a.node", F.coalesce("b.up", "a.up").alias("up"), F.col("b.up").isNotNull().alias("moved")
            )
        )
        hook = jumped.select("node", "up")
        if jumped.filter("moved").isEmpty():
            return hook


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the least node of its component.

    In each round every label hooks to its least neighbour, hooks are followed to their
    roots, and the edges are contracted. The labels that stay are local minima, so their
    number falls by half at least.
    """
    edges = _stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    labels = None
    while not edges.isEmpty():
        roots = _roots(_stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))))
        if labels is None:
            nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
            labels = nodes.withColumn("label", F.col("node"))
        up = roots.select(F.col("node").alias("label"), "up")
        labels = _stored(labels.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")))
        ra = roots.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        rb = roots.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        moved = (
            edges.join(ra, "a", "left").join(rb, "b", "left").select(F.coalesce("ua", "a").alias("x"), F.coalesce("ub", "b").alias("y"))
        )
        edges = _stored(
            moved.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
