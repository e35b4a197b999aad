"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeline.llm.tables import save


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); nodes with the same
    label are connected.

    Each round maps every node to the first of its neighbours and itself, then
    to that node's choice, relabels the edges and drops loops and repeats, until
    no edge is left.  Rounds alternate between order by id, which folds a star
    around its smallest node at once, and a random order, which shortens any
    chain by a constant factor.  A node with many edges is one row per task
    after map-side combine.
    """
    edges = save(edges.select("a", "b").where("a != b").distinct(), "cc-edges")
    labels, k = None, 0
    while edges.limit(1).count():
        rank = (lambda c: F.struct(c.alias("k"), c.alias("id"))) if k % 2 == 0 else (
            lambda c, k=k: F.struct(F.xxhash64(c, F.lit(k)).alias("k"), c.alias("id"))
        )
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = save(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(rank(F.col("b"))).alias("m"))
            .select("node", F.least(rank(F.col("node")), F.col("m"))["id"].alias("up")),
            "cc-first",
        )
        jump = first.select(F.col("node").alias("up"), F.col("up").alias("top"))
        first = save(first.join(jump, "up").select("node", F.col("top").alias("up")), "cc-jump")
        if labels is None:
            labels = first.select("node", F.col("up").alias("label"))
        else:
            nxt = first.select(F.col("node").alias("label"), "up")
            labels = save(
                labels.join(nxt, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "cc-labels"
            )
        a = first.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        b = first.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = save(
            edges.join(a, "a").join(b, "b").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).where("a != b").distinct(),
            "cc-edges",
        )
        k += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
