"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str]
) -> DataFrame:
    """`keys` plus the `take` columns of the row with the highest `order` columns.

    An aggregate rather than a ranked window: each task first reduces its rows to one per key,
    so a key with a large share of the rows costs no more to shuffle than any other. Spark can't
    update structs in place, so a task sorts its rows by key for that, and spills if it must.
    """
    newest = F.max_by(F.struct(*take), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *(F.col(f"_newest.{c}") for c in take))
