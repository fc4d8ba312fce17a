"""Nested records to flat tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[Column]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield F.col(".".join(f"`{part}`" for part in here)).alias("__".join(here))


def flatten_struct(df: DataFrame) -> DataFrame:
    """Every struct field as a column named by its path (`a.b.c` becomes `a__b__c`); lists stay."""
    return df.select(*_leaves(df.schema))


def child_rows(df: DataFrame, list_col: str, parent_keys: Sequence[str]) -> DataFrame:
    """One row per list element, with the parent's keys; NULL and empty lists give none.

    Elements that are structs become their fields, others become `value`.
    """
    element = df.schema[list_col].dataType.elementType
    rows = df.select(*parent_keys, F.explode(list_col).alias("_element"))
    if isinstance(element, T.StructType):
        return rows.select(*parent_keys, "_element.*")
    return rows.withColumnRenamed("_element", "value")
