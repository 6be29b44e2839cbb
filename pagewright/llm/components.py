"""Connected components of a distributed list of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import written


def _flat(hooks: DataFrame) -> DataFrame:
    """``a, b`` with every chain ``a -> b -> c`` followed to its end, by doubling."""
    while True:
        up = hooks.select(F.col("a").alias("_b"), F.col("b").alias("_c"))
        longer = written(hooks.join(up, hooks["b"] == up["_b"], "left").select(
            "a", F.coalesce("_c", "b").alias("b"), F.col("_c").isNotNull().alias("_moved")))
        hooks = longer.drop("_moved")
        if not longer.where("_moved").take(1):
            return hooks


def relabel(nodes: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``nodes`` with ``column`` replaced by its label; nodes without one keep themselves."""
    on = labels.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    out = nodes.join(on, nodes[column] == on["_a"], "left")
    return out.select(*[F.coalesce("_b", column).alias(column) if c == column else F.col(c) for c in nodes.columns])


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: for each node of ``edges`` (columns ``a, b``) that is not the smallest of
    its component, the smallest.

    In each round every node hooks to its smallest neighbour below it, chains are
    followed to their ends, and the edges are drawn between the ends.  The edges left
    shrink by a constant factor or more; the state is written between rounds.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    labels = None
    while edges.take(1):
        hooks = _flat(written(edges.groupBy("a").agg(F.min("b").alias("b"))))
        labels = hooks if labels is None else written(relabel(labels, "b", hooks).unionByName(hooks))
        drawn = relabel(relabel(edges, "a", hooks), "b", hooks).where("a <> b")
        edges = written(drawn.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    return edges if labels is None else labels
