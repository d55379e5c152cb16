"""Connected components of a graph given by edges between 64-bit nodes.

Rounds of large star and small star: every node links its larger neighbours,
then its smaller ones, to the smallest node it knows. After O(log n) rounds in
practice each node has one edge, to the smallest of its component: the edges
are stars, which no round changes, so the work ends where that is seen. Edges
only ever move between tasks; the driver sees two numbers per round. Minima
are combined on the map side, joins on hot nodes are left to adaptive
execution. Each round is a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import checkpointed

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, label) for every node that has an edge; label is the smallest node of its component."""
    e = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    e = checkpointed(e.distinct())
    for left in range(max_rounds, -1, -1):
        if _stars(e):
            break
        if not left:
            raise RuntimeError(f"no fixed point after {max_rounds} rounds")
        e = checkpointed(_small_star(_large_star(e)))
    pairs = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return pairs.unionByName(roots)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(e: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and no larger ones, or larger ones only."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(F.max("up"), F.max(F.when(F.col("up") > 0, F.col("down")))).first()
    return (row[0] or 0) <= 1 and not row[1]
