"""Connected components of a graph in a DataFrame, and a union-find for graphs in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


class UnionFind:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> int:
        """The smaller root becomes the root of both."""
        x, y = self.find(x), self.find(y)
        if x > y:
            x, y = y, x
        self.parent[y] = x
        return x


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b) of longs: the smallest node reachable, for every node of an edge.

    Large stars and small stars in turn: each turn hooks the larger neighbours of every node to its smallest neighbour, then the smaller
    ones. The edges become stars in about log(nodes) turns. Each turn is written to the shared folder, and the one before it deleted; nothing is collected but a count.
    """
    edges = written(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    known = _signature(edges)
    while known[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        # a node that is its own smallest keeps its larger neighbours as they are
        large = large.distinct()
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_min, "a")
        turned = small.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small_min.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        after = written(turned)
        dropped(edges)
        before, known, edges = known, _signature(after), after
        if known == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _signature(edges: DataFrame) -> tuple[int, int, int]:
    """Count and two checksums of distinct edges."""
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")).first()
    return row[0], row[1] or 0, row[2] or 0
