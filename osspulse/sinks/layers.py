"""Warehouse layers as databases, their names used as they are."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from enum import StrEnum

from pyspark.sql import DataFrame, SparkSession

from osspulse import schemas


class Layer(StrEnum):
    RAW = "raw"
    STAGING = "staging"
    INTERMEDIATE = "intermediate"
    MARTS = "marts"
    SNAPSHOTS = "snapshots"

    def table(self, name: str) -> str:
        return f"{self.value}.{name}"


def ensure_layers(spark: SparkSession) -> None:
    for layer in Layer:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer.value}")


class _CatalogMarts(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession):
        self._spark = spark

    def __getitem__(self, name: str) -> DataFrame:
        # Without columns that only place the rows.
        return self._spark.table(Layer.MARTS.table(name)).select(*schemas.MARTS[name].fieldNames())

    def __iter__(self) -> Iterator[str]:
        return iter(schemas.MARTS)

    def __len__(self) -> int:
        return len(schemas.MARTS)


def catalog_marts(spark: SparkSession) -> Mapping[str, DataFrame]:
    """The stored marts by name, for `osspulse.plans.queries`."""
    return _CatalogMarts(spark)
