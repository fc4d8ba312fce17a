"""Exact medians by rounds of histograms, for groups with more distinct values than one buffer should hold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.sinks.staging_area import cut_lineage

BINS, SALTS = 1024, 32
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def exact_median(
    runs: DataFrame, keys: Sequence[str], value: str, count: str, name: str = "median", bins: int = BINS, salts: int = SALTS
) -> DataFrame:
    """The interpolated median of the whole numbers `value`, each occurring `count` times, per group of `keys`.

    A round counts the values of a group in at most `bins` bins of equal width, and goes on with the bin that holds
    the middle, so ranges shrink by that factor: seven rounds at most for 64 bits, two or three for values of
    one day to the second or one year. Where the two middle values are in different bins, they are the
    largest of one and the smallest of the other. No task sees a group whole: its values are counted where they
    lie, and meet the group's range in `salts` parts. Two rows per group and bin are the most that is kept.

    NULL values, and counts below one, do not take part; a group without others has NULL. NULL keys are a group.
    A value may stand in several rows. Without keys there is one row, also for an empty input.
    """
    if not isinstance(runs.schema[value].dataType, WHOLE):
        raise TypeError(f"{value} is no whole number")
    if bins < 2:
        raise ValueError("a round needs two bins at least")
    keys = list(keys)
    counted = F.when(F.col(count) > 0, F.col(count)).cast("long")
    number = F.when(counted.isNotNull(), F.col(value)).cast("long")
    rows = cut_lineage(runs.select(*keys, number.alias("_value"), F.when(number.isNotNull(), counted).alias("_n")))
    total = F.sum("_n")
    state = rows.groupBy(*keys).agg(
        F.min("_value").alias("_lo"),
        F.max("_value").alias("_hi"),
        F.expr("(sum(_n) - 1) div 2").alias("_low"),
        F.floor(total / 2).cast("long").alias("_high"),
    )
    state = cut_lineage(state.withColumn("_below", F.lit(0).cast("long")))
    same = F.col("_lo").isNull() | (F.col("_lo") == F.col("_hi"))
    done = [state.filter(same).select(*keys, F.col("_lo").cast("double").alias(name))]
    open_groups = state.filter(~same)
    while not open_groups.isEmpty():
        inside = cut_lineage(_with_range(rows, open_groups, keys, bins, salts))
        found = cut_lineage(_middle_bins(inside, keys))
        closed = (F.col("_bins") == 2) | (F.col("_lo") == F.col("_hi"))
        middle = F.col("_first").cast("double") / 2 + F.col("_last").cast("double") / 2
        done.append(found.filter(closed).select(*keys, middle.alias(name)))
        rows, open_groups = inside.select(*keys, "_value", "_n"), found.filter(~closed)
    return reduce(DataFrame.unionByName, done)


def _with_range(rows: DataFrame, state: DataFrame, keys: Sequence[str], bins: int, salts: int) -> DataFrame:
    """Rows inside their group's range, with the number of their bin and the group's ranks.

    Ranges too wide for 64 bits are binned by the upper 63.
    """
    origin, top = F.expr("shiftright(_lo, _shift)"), F.expr("shiftright(_hi, _shift)")
    wide = F.expr("shiftright(_hi, 1) - shiftright(_lo, 1)") >= 1 << 61
    ranges = (
        state.withColumn("_shift", F.when(wide, 1).otherwise(0))
        .withColumns({"_origin": origin, "_top": top})
        .withColumn("_width", F.expr(f"(_top - _origin) div {bins}") + 1)
        .select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), "_lo", "_hi", "_shift", "_origin", "_width", "_low", "_high", "_below")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = rows.filter(F.col("_value").isNotNull()).withColumn("_part", F.pmod(F.xxhash64("_value"), F.lit(salts)).cast("int"))
    match: Column = F.col("_part") == F.col("_salt")
    for i, key in enumerate(keys):
        match = match & F.col(key).eqNullSafe(F.col(f"_key{i}"))
    joined = salted.join(ranges, match & F.col("_value").between(F.col("_lo"), F.col("_hi")))
    place = F.expr("(shiftright(_value, _shift) - _origin) div _width")
    return joined.select(*keys, "_value", "_n", place.alias("_bin"), "_low", "_high", "_below")


def _middle_bins(inside: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group the range of the one or two bins that hold the middle; the window sees one row per bin."""
    histogram = inside.groupBy(*keys, "_bin", "_low", "_high", "_below").agg(
        F.sum("_n").alias("_n"), F.min("_value").alias("_min"), F.max("_value").alias("_max")
    )
    by_bin = Window.partitionBy(*(keys or [F.col("_low")])).orderBy("_bin")
    before = F.col("_below") + F.sum("_n").over(by_bin) - F.col("_n")
    picked = histogram.withColumn("_before", before).filter(
        (F.col("_before") <= F.col("_high")) & (F.col("_before") + F.col("_n") > F.col("_low"))
    )
    return picked.groupBy(*keys, "_low", "_high").agg(
        F.min("_min").alias("_lo"),
        F.max("_max").alias("_hi"),
        F.min("_max").alias("_first"),
        F.max("_min").alias("_last"),
        F.min("_before").alias("_below"),
        F.count(F.lit(1)).alias("_bins"),
    )
