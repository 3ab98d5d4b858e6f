"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presscheck.llm.tables import materialise


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``(a, b)``; a component is its smallest node.

    In each round a node takes the smallest label of its neighbours and then the label
    of its label, until nothing changes. Rounds are stored in the shared folder, and only
    a count comes to the driver. Minima are taken before the shuffle, so a node of very
    many links is no burden; its side of the join is split where it is skewed. Links with
    a null end are ignored; without links there are no nodes.
    """
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = known.select("a", "b").unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.where(F.col("a") != F.col("b")).distinct(), "edges")
    first = edges.groupBy("a").agg(F.min("b").alias("b"))
    labels = materialise(first.select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("component").alias("seen"))
        near = edges.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select("node", F.least("component", "seen").alias("low"), "component")
        lower = materialise(lower, "labels")
        of = lower.select(F.col("node").alias("low"), F.col("low").alias("next"))
        jumped = lower.join(of, "low").select(
            "node", F.least("low", "next").alias("new"), (F.col("component") != F.least("low", "next")).alias("moved")
        )
        jumped = materialise(jumped, "labels")
        labels = jumped.select("node", F.col("new").alias("component"))
        if jumped.where("moved").isEmpty():
            return labels
