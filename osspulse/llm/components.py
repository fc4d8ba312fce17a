"""Connected components of a graph that no task and no driver sees whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from osspulse.llm.common import stored


def signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (the smallest node it reaches) for each node of `edges` (columns a, b).

    Rounds of large star (neighbours above a node go to the smallest one around it) and small star
    (the others below it go there too), until nothing changes. Minima are combined before the
    shuffle, so a hub is no hot group there; the join that hands them out splits large partitions.
    Every round is a stored table. Loops and repeated edges are harmless; nulls are dropped.
    """
    current = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = signature(current)
    if seen[0] == 0:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stored(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = signature(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
