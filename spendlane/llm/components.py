"""Connected components of an edge table by alternating star steps.

Each round replaces, for every node, its links by links to the smallest
neighbour: first for larger neighbours, then for smaller ones.  The number of
rounds grows with the logarithm of the longest chain.  Minima are combined
map-side, a hot node is only ever on the splittable side of a join, and the edges
of each round are written to the shared folder, so lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge runs from the larger to the smaller node after a large star
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for each node of ``edges`` (longs a, b
    in either direction, repeats and loops allowed).  An empty table gives an empty
    table."""
    current = written(edges.where("a <> b").select("a", "b"), "edges")
    mark = _mark(current)
    while True:
        current = written(_small_star(_large_star(current)), "edges")
        now = _mark(current)
        if now == mark:
            break
        mark = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
