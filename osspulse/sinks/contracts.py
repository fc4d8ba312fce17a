"""Schema checks before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(ValueError):
    """A frame does not have the promised columns."""


def _types(schema: T.StructType) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in schema.fields}


def _differences(expected: T.StructType, actual: T.StructType) -> list[str]:
    want, have = _types(expected), _types(actual)
    return [
        f"{name}: expected {want.get(name, 'no column')}, got {have.get(name, 'no column')}"
        for name in sorted(want.keys() | have.keys())
        if want.get(name) != have.get(name)
    ]


def assert_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with its columns in contract order; names and types must match, nothing is cast."""
    problems = _differences(schema, df.schema)
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*schema.fieldNames())


def assert_same_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """`batch` in the column order of `target`; any added, dropped or retyped column fails."""
    return assert_contract(batch, target.schema)
