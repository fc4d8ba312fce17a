"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def fresh_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now, also if another session (a stream's, say) rewrote it."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows of `schema` when it was never written."""
    if spark.catalog.tableExists(name):
        return fresh_table(spark, name)
    return spark.createDataFrame([], schema)


def has_marts(spark: SparkSession) -> bool:
    """True once the marts were built at least once."""
    return spark.catalog.tableExists("marts.dim_repositories")
