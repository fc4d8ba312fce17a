"""Joins between facts and dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def spread_null(key: Column, spread_by: Column) -> Column:
    """`key`, or for rows without one a made-up key from the full hash of `spread_by`.

    No real key looks like it; the join condition still has to keep such rows unmatched.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(spread_by).cast("string")))


def scd2_join(
    facts: DataFrame,
    versions: DataFrame,
    name: Column,
    day: Column,
    take: Sequence[str] = ("repository_key",),
    salts: int = 1,
) -> DataFrame:
    """Left join to the version in force on `day`: `valid_from <= day < valid_to`.

    The name is an equality key, so this is a hash or merge join with the range as a residual
    condition. Spark broadcasts `versions` if they turn out small. Otherwise rows without a name are
    spread by their day, and hot names are split by the event day over `salts` copies of the versions.
    """
    sides = [
        F.col("repository_name").alias("_version_name"),
        F.col("valid_from").alias("_version_from"),
        F.col("valid_to").alias("_version_to"),
        *(F.col(column) for column in take),
    ]
    right = versions.select(*sides)
    match = (
        (spread_null(name, day) == F.col("_version_name"))
        & (day >= F.col("_version_from"))
        & (day < F.col("_version_to"))
    )
    helpers = ["_version_name", "_version_from", "_version_to"]
    if salts > 1:
        facts = facts.withColumn("_fact_salt", F.pmod(F.coalesce(F.unix_date(day), F.lit(0)), F.lit(salts)))
        right = right.withColumn("_version_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        match = match & (F.col("_fact_salt") == F.col("_version_salt"))
        helpers += ["_fact_salt", "_version_salt"]
    return facts.join(right, match, "left").drop(*helpers)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    take: dict[str, str],
    spread_by: str,
    salts: int = 1,
) -> DataFrame:
    """Left join on one key, taking `{dim column: result column}`.

    Facts without a key match nothing but would all hash to one task; they are spread by the full
    hash of `spread_by`, and the condition keeps them unmatched. With `salts` above 1 a hot key is split
    over that many copies of the dimension, by the same hash; with 1 and a dimension that is known to be
    distinct, Catalyst drops the join from plans that read none of its columns.
    """
    right = dim.select(
        F.col(dim_key).alias("_dim_key"), *(F.col(old).alias(new) for old, new in take.items())
    )
    keyed = facts.withColumn("_fact_key", spread_null(F.col(fact_key), F.col(spread_by)))
    match = (F.col("_fact_key") == F.col("_dim_key")) & F.col(fact_key).isNotNull()
    if salts > 1:
        right = right.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keyed = keyed.withColumn("_fact_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
        match = match & (F.col("_fact_salt") == F.col("_dim_salt"))
    return keyed.join(right, match, "left").drop("_fact_key", "_dim_key", "_fact_salt", "_dim_salt")
