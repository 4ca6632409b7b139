"""Connected components as repeated joins over an edge table (large star and small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    out = down.join(low, "a")
    return (out.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(low.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), the root the smallest node of
    its component.  Each round is written to the shared folder; the number of rounds
    grows with the logarithm of the longest path."""
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == before:
            break
        before = mark
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
