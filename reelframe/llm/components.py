"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rounds


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Rows ``(node, root)`` for every node of ``edges`` (columns a and b, one
    orderable type): root is the least node that can be reached.

    Alternates large and small stars until the edge list stays as it is,
    about log(nodes) rounds. A node with very many edges is never one
    group: minima are pre-aggregated and joined back on a unique side, so
    adaptive execution may split the other. Each round is stored in the
    shared folder, in place of the one before. Loops, null ends and repeated edges are ignored; no edges
    give no rows.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    rounds = Rounds("edges")
    now = rounds.store(now)
    sign = None
    for _ in range(max_rounds):
        now = rounds.store(_small_star(_large_star(now)))
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == sign:
            break
        sign = tuple(row)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
