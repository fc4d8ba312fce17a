"""Keyed merges of a batch into a target, as plain frames.

`osspulse.sinks.merge_table` applies them to stored tables partition by partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.operators.latest import latest_per_key


def latest_in_batch(batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the highest `order_by` columns, of equal ones the highest in the other columns' own order.

    Order by the version first and then by when and where a row landed, so that content decides
    between rows of one file only. Columns of a type without an order are compared as JSON text.
    """
    others = [column for column in batch.columns if column not in keys]
    settled = {f"_order{i}": _comparable(batch, c) for i, c in enumerate(c for c in others if c not in order_by)}
    ranked = batch.withColumns(settled)
    return latest_per_key(ranked, keys, [*order_by, *settled], others).select(*batch.columns)


def _comparable(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.MapType, T.VariantType)):
        return F.to_json(F.struct(column))
    return F.col(column)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Target rows whose key is absent from the batch, and the batch with one row per key."""
    newest = latest_in_batch(batch, keys, order_by)
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(newest)


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is absent from the batch, and the whole batch, repetitions included."""
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(batch)
