"""Connected components by alternating large-star and small-star rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merch.session import staged


def components(edges: DataFrame, *, rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge in ``edges`` (a, b longs).

    Every round is an aggregate with map-side combine and a join, which the engine may split at a hot node, and ends in
    a staged table, so lineage stays short. Nodes without an edge do not come out. Edges from a node to itself, null
    ends, repeated edges and both directions are allowed. The rounds end when no edge changes.
    """
    flat = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = staged(flat.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(rounds):
        now = staged(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(now.select("b", "b").distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    return tuple(row.first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    hit = both.join(least, F.col("a") == F.col("n")).where("b > a")
    return hit.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest neighbour."""
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    hit = edges.join(least, F.col("a") == F.col("n"))
    return (
        hit.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )
