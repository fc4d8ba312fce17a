"""Exact distinct counts that add up: dense numbers for persons, and bitmaps of the numbers per group.

A set of persons is a row per bucket of 32,768 numbers with a bitmap of those that are in it. Sets are united by `or`, so
a count over any months and groups comes from stored bitmaps alone, without the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from osspulse.operators.numbering import row_numbers


def numbered_persons(persons: DataFrame, known: DataFrame | None = None, person: str = "username") -> DataFrame:
    """`person` and its `number`, gapless from 1: those `known` keep theirs, and new ones get the next, in text order."""
    fresh = persons.select(person).filter(F.col(person).isNotNull()).distinct()
    if known is None:
        return row_numbers(fresh, [F.col(person)], "number").select(person, "number")
    start = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("start")).first()[0]
    added = row_numbers(fresh.join(known.select(person), person, "left_anti"), [F.col(person)], "number")
    return known.select(person, "number").unionByName(added.select(person, (F.col("number") + start).alias("number")))


def person_bitmaps(rows: DataFrame, numbers: DataFrame, groups: Sequence[str], person: str = "username") -> DataFrame:
    """`groups`, `bucket` and `bits`: the persons of each group. Rows without a number do not count.

    Repeated persons of a group are dropped before the join, so that a busy one costs a row per group.
    """
    each = rows.select(*groups, person).filter(F.col(person).isNotNull()).distinct()
    numbered = each.join(numbers, person)
    bucket = F.bitmap_bucket_number(F.col("number")).alias("bucket")
    return numbered.groupBy(*groups, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("number"))).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sets of coarser groups, or of stored and new bitmaps under one another."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def persons_in(bitmaps: DataFrame, groups: Sequence[str], name: str = "contributors") -> DataFrame:
    """How many persons each of the `groups` has; without groups, how many there are in all."""
    united = merge_bitmaps(bitmaps, groups)
    total = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name)
    return united.groupBy(*groups).agg(total) if groups else united.agg(total)
