"""Checks on tables. No violations means the check passes.

`Check.violations(df)` gives the offending rows (or values, with how many rows have them).
`run_checks` summarizes a suite: every check that looks at one row at a time is a conditional count
in one shared pass, and the others are aggregates that combine before they shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from osspulse.functions import utc_naive


@dataclass(frozen=True)
class Check:
    """`row_fails` marks bad rows; `find` gives violations where one row cannot tell.

    `weight` names the column of `find` with the number of rows a violation stands for. `bounds` are
    those of a table's row count.
    """

    name: str
    severity: str
    row_fails: Column | None = None
    find: Callable[[DataFrame], DataFrame] | None = None
    weight: str | None = None
    bounds: tuple[int, int | None] | None = None

    def violations(self, df: DataFrame) -> DataFrame:
        return self.find(df) if self.find is not None else df.filter(self.row_fails)


def not_null(column: str, severity: str = "error") -> Check:
    return Check(f"not_null({column})", severity, F.col(column).isNull())


def accepted_values(column: str, values: Sequence[Any], severity: str = "error") -> Check:
    """NULL is accepted."""
    known = F.col(column)
    return Check(f"accepted_values({column})", severity, known.isNotNull() & ~known.isin(list(values)))


def between(
    column: str, low: Any = None, high: Any = None, where: str | None = None, severity: str = "error"
) -> Check:
    """Closed range, either end optional, over the rows that meet `where`; NULL passes."""
    value = F.col(column)
    out = F.lit(False)
    if low is not None:
        out = out | (value < low)
    if high is not None:
        out = out | (value > high)
    if where is not None:
        out = F.expr(where) & out
    return Check(f"between({column},{low},{high})", severity, F.coalesce(out, F.lit(False)))


def expression(condition: str, severity: str = "error") -> Check:
    """`condition` holds; a NULL outcome passes."""
    return Check(f"expression({condition})", severity, F.coalesce(~F.expr(condition), F.lit(False)))


def unique(*columns: str, severity: str = "error") -> Check:
    """No value (or combination) twice. A lone NULL column may repeat, NULL in a combination not."""

    def find(df: DataFrame) -> DataFrame:
        rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
        return rows.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")

    return Check(f"unique({','.join(columns)})", severity, find=find)


def relationships(column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> Check:
    """Every value exists in `parent`; NULL passes. Values are counted before they meet the parent."""

    def find(df: DataFrame) -> DataFrame:
        values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
        keys = parent.select(F.col(parent_column).alias(column))
        return values.join(keys, column, "left_anti")

    return Check(f"relationships({column})", severity, find=find, weight="n_rows")


def adjacent_ranges(key: str, lower: str, upper: str, severity: str = "error") -> Check:
    """Per key each range is not empty and ends where the next begins: no overlap, no gap.

    The window holds the ranges of one key, e.g. the versions of one repository.
    """

    def find(df: DataFrame) -> DataFrame:
        follows = F.lead(lower).over(Window.partitionBy(key).orderBy(lower, upper))
        ranges = df.select(key, lower, upper, follows.alias("next_lower"))
        last = F.col("next_lower").isNull()
        # The last range may be open-ended (NULL).
        sound = F.coalesce(F.col(lower) < F.col(upper), last)
        touching = F.coalesce(F.col(upper) == F.col("next_lower"), last)
        return ranges.filter(~(sound & touching))

    return Check(f"adjacent_ranges({key},{lower},{upper})", severity, find=find)


def row_count(low: int, high: int | None, severity: str = "error") -> Check:
    """Number of rows within the closed range; no `high`, no upper bound."""

    def find(df: DataFrame) -> DataFrame:
        n = F.col("n_rows")
        sound = n >= low if high is None else n.between(low, high)
        return df.agg(F.count("*").alias("n_rows")).filter(~sound)

    return Check(f"row_count({low},{high})", severity, find=find, bounds=(low, high))


def missing_days(calendar: DataFrame, day: str) -> DataFrame:
    """Days whose next day in the calendar is not the day after, with that `next_date`.

    In two levels, so that no window spans the whole table: next day within the year, and for the
    last day of a year the first one of the next year present (a list with one entry per year).
    """
    year = F.year(day)
    within = Window.partitionBy("_year").orderBy(day)
    days = calendar.select(day, year.alias("_year")).withColumn("_next", F.lead(day).over(within))
    firsts = F.array_sort(F.collect_list("_first"))
    years = days.groupBy("_year").agg(F.min(day).alias("_first")).agg(firsts.alias("_firsts"))
    pairs = F.arrays_zip(
        F.col("_firsts").alias("first"), F.slice("_firsts", 2, F.size("_firsts")).alias("following")
    )
    following = years.select(F.inline(pairs)).select(
        F.year("first").alias("_year"), F.col("following").alias("_following")
    )
    chained = days.join(F.broadcast(following), "_year").select(
        day, F.coalesce("_next", "_following").alias("next_date")
    )
    return chained.filter(F.col("next_date") != F.date_add(day, 1))


def contract(df: DataFrame, schema: Any) -> DataFrame:
    """Columns that differ from the contract: `column, expected, actual` (NULL = absent)."""
    expected = {field.name: field.dataType.simpleString() for field in schema.fields}
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    names = sorted(set(expected) | set(actual))
    rows = [(n, expected.get(n), actual.get(n)) for n in names if expected.get(n) != actual.get(n)]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string")


def freshness(
    tables: dict[str, DataFrame], as_of: datetime, warn_hours: int | None, error_hours: int | None
) -> DataFrame:
    """Age in seconds of each table's newest `_loaded_at`, and `pass`, `warn` or `error`.

    A table that was never loaded is an error.
    """
    now = F.lit(utc_naive(as_of).isoformat(sep=" ")).cast("timestamp_ntz")
    result = None
    for name, df in tables.items():
        newest = F.max("_loaded_at").cast("timestamp_ntz")
        one = df.agg(newest.alias("newest")).select(F.lit(name).alias("table"), "newest")
        result = one if result is None else result.unionByName(one)
    age = F.timestamp_diff("SECOND", F.col("newest"), now).cast("bigint")
    status = F.when(F.col("newest").isNull(), "error")
    if error_hours is not None:
        status = status.when(age > error_hours * 3600, "error")
    if warn_hours is not None:
        status = status.when(age > warn_hours * 3600, "warn")
    return result.select("table", "newest", age.alias("age_seconds"), status.otherwise("pass").alias("status"))


def run_checks(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """One row per check: `check, severity, violations, status` (`pass`, `warn` or `error`)."""
    by_row = [check for check in suite if check.row_fails is not None]
    parts: list[DataFrame] = []
    if by_row:
        counts = df.agg(*(F.count_if(c.row_fails).alias(f"c{i}") for i, c in enumerate(by_row)))
        summary = F.array(
            *(
                F.struct(
                    F.lit(c.name).alias("check"),
                    F.lit(c.severity).alias("severity"),
                    F.col(f"c{i}").alias("violations"),
                )
                for i, c in enumerate(by_row)
            )
        )
        parts.append(counts.select(F.inline(summary)))
    for check in suite:
        if check.row_fails is None:
            size = F.count("*") if check.weight is None else F.coalesce(F.sum(check.weight), F.lit(0))
            found = check.violations(df).agg(size.cast("bigint").alias("violations"))
            parts.append(
                found.select(
                    F.lit(check.name).alias("check"), F.lit(check.severity).alias("severity"), "violations"
                )
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    status = F.when(F.col("violations") == 0, "pass").otherwise(F.col("severity"))
    return result.withColumn("status", status)
