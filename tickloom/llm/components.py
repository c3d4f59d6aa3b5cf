"""Connected components of a graph given by its edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node ties neighbours to the least node it knows.

    In a large star a node ties its larger neighbours, in a small star its smaller ones and itself.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.unionByName(turned) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("least"))
    tied = around.join(least, "a").select(
        "b", F.least("a", "least").alias("least")
    )
    if large:
        tied = tied.where("b > least")
        own = least.where("least < a").select(F.col("a").alias("b"), "least")
    else:
        own = least.select(F.col("a").alias("b"), "least")
    both = tied.unionByName(own).where("b > least")
    return both.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with an edge.

    ``edges`` has BIGINT columns ``a`` and ``b`` in either direction; self-loops, repeated edges and
    edges with a null say nothing. Large-star and small-star steps alternate until the edges no
    longer change; their number grows with the logarithm of the nodes. Each step is written to the
    shared folder, and nothing but two numbers a step comes to the driver. A node with very many
    neighbours is one key of a join whose other side has one row per node.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = stage(
        edges.select(a.alias("a"), b.alias("b")).where("a > b").distinct(), "component-edges"
    )
    seen = None
    while True:
        mark = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = stage(_stars(_stars(now, large=True), large=False), "component-edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
