"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least of its neighbourhood."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and itself, go to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (two columns of one number
    type): root is the least node of its component. Loops, repeats and nulls
    among the edges are ignored. Each round is written to the shared folder;
    rounds grow with the logarithm of the nodes."""
    a, b = edges.columns
    now = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "edges")
    state = None
    while True:
        after = written(_small_star(_large_star(now)).distinct(), "edges")
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state, now = tuple(mark), after
