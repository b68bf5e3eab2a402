"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import saved

#: Rounds double the reach at least; a graph of 2^40 nodes in one path ends sooner.
MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's least node.

    Alternates two steps until no edge changes: every node hands its larger
    neighbours to its least one, then its smaller ones. The number of rounds grows
    with the logarithm of the longest path, an edge table never grows, and a node
    with very many neighbours costs rows, never a list. Each round is written to the
    shared folder, so that a lost executor costs one step.
    """
    edges = (
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    edges, before = saved(edges, "edges"), None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            # every edge is now (root, node)
            own = edges.select(F.col("a").alias("node")).distinct()
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                own.select("node", F.col("node").alias("root"))
            )
        before = state
        edges = saved(_hand_over(_hand_over(edges, larger=True), larger=False), "edges")
    raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")


def _hand_over(edges: DataFrame, larger: bool) -> DataFrame:
    """One step: (a, b) with a < b, to edges between neighbours and the least of them."""
    if larger:
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        pairs = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if larger:
        least = least.withColumn("m", F.least("u", "m"))
        out = pairs.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = (
            pairs.join(least, "u")
            .select("m", F.explode(F.array("u", "v")).alias("b"))
            .select(F.col("m").alias("a"), "b")
        )
    return out.where("a <> b").distinct()
