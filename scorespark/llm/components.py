"""Connected components by hooking, pointer jumping and contraction, each step a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.session import materialize


def component_roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge; root is a node that all of a component share.

    In a round, every node hooks to its smallest neighbour if that is smaller
    (a minimum, combined inside the tasks before the shuffle), pointers are
    doubled until each names the top of its tree, and the edges are rewritten
    to those tops.  Rounds end when no edge between two tops is left.  Nothing
    but row counts reaches the driver, and nodes with very many edges are never
    gathered: their rows meet only in minima and in joins that can be split.
    """
    low, high = F.least(a, b).alias("a"), F.greatest(a, b).alias("b")
    links = materialize(edges.select(low, high).where("a < b").distinct(), "links")
    labels = materialize(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node")), "labels")
    while links.limit(1).count():
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        tops = _jump(materialize(hooks, "hooks"))
        step = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = materialize(
            labels.join(step, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels"
        )
        x, y = step.select(F.col("root").alias("a"), F.col("top").alias("x")), step.select(F.col("root").alias("b"), F.col("top").alias("y"))
        moved = links.join(x, "a").join(y, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = materialize(moved.distinct(), "links")
    return labels


def _jump(pointers: DataFrame) -> DataFrame:
    """Every node's pointer moved on to the top of its tree."""
    while True:
        above = pointers.select(F.col("node").alias("root"), F.col("root").alias("next")).where("root <> next")
        moved = pointers.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialize(moved, "pointers")
        pointers = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return pointers
