"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import cut_lineage, drop_table


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`edges` has two long columns a and b. Returns (node, root): root is the smallest node reachable.

    Alternating large-star and small-star rounds: every node hands its larger, then
    its smaller neighbours to the smallest node it knows. A round aggregates and joins
    on nodes, so a hub never meets in one task whole; only two numbers a round reach
    the driver. Each round is written to the shared folder. Loops and repeated edges
    are allowed; no edges give no rows. Nodes of no edge have no row.
    """
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    for _ in range(most_rounds):
        after = cut_lineage(_small_star(_large_star(now)))
        drop_table(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                now.select("b", "b").distinct()
            )
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    """Count and digest of a set of edges."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node get the smallest of the node and all its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get the smallest of them. Edges lead from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    handed = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
