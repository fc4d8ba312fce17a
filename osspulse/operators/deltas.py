"""Changes of a table as signed rows, and what they do to counts that were kept of it.

A row that is gone has the sign -1, a new one +1; a changed row is both. Projections, filters and joins with a
table that did not change apply to such rows as to any others, and counts take the sum of the signs,
so a table that is kept as counts per finest key follows from its old state and the changes alone, retractions included.
Minima and maxima are then taken over keys whose count is left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGN = "_sign"


def signed(minus: DataFrame, plus: DataFrame) -> DataFrame:
    """One frame of changes from the rows that are gone and the new ones."""
    return minus.withColumn(SIGN, F.lit(-1)).unionByName(plus.withColumn(SIGN, F.lit(1)))


def split(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that are gone and the new ones."""
    return changes.filter(F.col(SIGN) < 0).drop(SIGN), changes.filter(F.col(SIGN) > 0).drop(SIGN)


def through(changes: DataFrame, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Changes of what `plan` makes of a table, for plans that work on each row alone."""
    minus, plus = split(changes)
    return signed(plan(minus), plan(plus))


def net(changes: DataFrame) -> DataFrame:
    """Changes without those that cancel out, as when a row was replaced twice or by itself.

    A row that is left more than once has the sum of its signs.
    """
    columns = [c for c in changes.columns if c != SIGN]
    return changes.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)


def count_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How the number of rows of each key changes: `keys` and `n`, without zeros."""
    return changes.groupBy(*keys).agg(F.sum(SIGN).alias("n")).filter("n <> 0")


def add_counts(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts after the changes; keys that have no rows left are gone. Null equals null in keys."""
    both = state.select(*keys, "n").unionByName(changes.select(*keys, "n"))
    return both.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n > 0")


def replace_keys(table: DataFrame, gone: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`table` without the keys in `gone`, and the `fresh` rows."""
    return table.join(gone.select(*keys).distinct(), list(keys), "left_anti").unionByName(fresh)
