"""Connected components of an edge table, by alternating star contraction.

Each round links every node's larger neighbours to its smallest one, then the smaller ones; the number of
rounds grows with the logarithm of a component's size.  A hub with very many neighbours is only ever
pre-aggregated (a minimum) and joined, never gathered.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brambling.llm.common import settle


def _mark(edges: DataFrame):
    """What tells two edge tables apart: the number of edges and the sum of their hashes."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Loops and repeated edges do no harm; an empty edge table gives no rows.
    """
    star = settle(edges.filter(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = star.union(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = settle(both.join(least, "a").filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
                       .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = settle(down.union(least.select("a", F.col("m").alias("b"))).distinct())
        mark = _mark(star)
        if mark == before:
            break
        before = mark
    roots = star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return star.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
