"""The place of each row in a global order, from the ordered partitions alone."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osspulse.sinks.staging_area import cut_lineage


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "position", is_sorted: bool = False) -> DataFrame:
    """`df` with the place of each row, from 1, in the given order; or, if it `is_sorted`, as its rows stand.

    Rows are sorted over range partitions. A row's number in its partition comes from the id that
    Spark gives it there, and the partitions' offsets are sums of the counts of earlier ones: one number per
    partition goes through the driver. The sorted rows are kept once, as both steps must see the same ones.
    Rows that tie in the order are numbered as they lie.
    """
    ordered = df if is_sorted else df.orderBy(*order)
    # The upper bits of the id are the partition, the lower ones the place in it.
    kept = cut_lineage(ordered.withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    counts = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    offsets = [(row.part, start) for row, start in zip(counts, accumulate((row.n for row in counts), initial=0), strict=False)]
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    placed = kept.withColumn("_part", part).join(F.broadcast(starts), "_part")
    number = F.col("_start") + F.col("_row").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn(name, number).select(name, *df.columns)
