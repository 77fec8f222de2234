"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import cut


def _sum(edges: DataFrame) -> tuple:
    """Order-free content sum of an edge table."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _least(both: DataFrame) -> DataFrame:
    """(u, m): smallest of u and its neighbours. A hub is one pre-aggregated row."""
    return both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: columns a, b (long). Result: node, component (smallest node reachable).

    Nodes without an edge to another node get no row; self loops and repeated
    edges are ignored; rows with nulls too. Each round writes a reliable
    checkpoint, and only an edge count and sum come to the driver. The star
    steps are aggregates and joins, so a hub's neighbours are never gathered."""
    now = cut(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct()
    )
    before = _sum(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = _least(large)
        small = large.join(least, "u")
        now = cut(
            small.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        after = _sum(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    root = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return root.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


class UnionFind:
    """Disjoint sets over positions 0..n-1; the smallest position is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def union(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
