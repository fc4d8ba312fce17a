"""Slowly changing history (type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osspulse.functions import utc_literal

# The validity columns of a history are `dbt_valid_from` and `dbt_valid_to`; the end of
# a range that is still open, at date grain.
OPEN_END = "9999-12-31"


def scd2_snapshot(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | Column,
) -> DataFrame:
    """`history` after seeing `current` at `run_ts`.

    History has the columns of `current` and `dbt_valid_from`, `dbt_valid_to` (NULL = open). A new
    key opens a row. A key with any changed `check_cols` (NULL equals NULL) closes its open row
    and opens another. A key absent from `current` stays open; other columns of an unchanged key
    stay as they were when its row opened.
    """
    now = run_ts if isinstance(run_ts, Column) else utc_literal(run_ts)
    columns = current.columns
    is_open = F.col("dbt_valid_to").isNull()
    closed = history.filter(~is_open).select(*columns, "dbt_valid_from", "dbt_valid_to")

    old = history.filter(is_open).select(F.struct(*columns, "dbt_valid_from").alias("old"))
    new = current.select(F.struct(*columns).alias("new"))
    pairs = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    differs = reduce(
        lambda a, b: a | b, (~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols)
    )
    known, seen = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = known & seen & differs
    # Each pair yields its old row (closed if changed) and, if new or changed, an opened row.
    old_row = F.struct(
        *(F.col(f"old.{c}").alias(c) for c in columns),
        F.col("old.dbt_valid_from").alias("dbt_valid_from"),
        F.when(changed, now).alias("dbt_valid_to"),
    )
    new_row = F.struct(
        *(F.col(f"new.{c}").alias(c) for c in columns),
        now.alias("dbt_valid_from"),
        F.lit(None).alias("dbt_valid_to"),
    )
    rows = F.array_compact(
        F.array(F.when(known, old_row), F.when(seen & (~known | differs), new_row))
    )
    return closed.unionByName(pairs.select(F.explode(rows).alias("row")).select("row.*"))
