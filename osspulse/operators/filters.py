"""Row selection shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osspulse.functions import utc_naive

# A choice of repositories: names, a one-column frame of names, or None for all of them.
Repos = Sequence[str] | DataFrame | None


def by_repos(df: DataFrame, repos: Repos, column: str = "repository_name") -> DataFrame:
    """Rows of the chosen repositories; an empty list keeps none."""
    if repos is None:
        return df
    if isinstance(repos, DataFrame):
        return df.join(repos.toDF(column), column, "left_semi")
    return df.filter(F.col(column).isin(list(repos)))


def by_dates(
    df: DataFrame, column: str, date_from: date | None = None, date_to: date | None = None
) -> DataFrame:
    """Closed range; without both ends there is no bound."""
    if date_from is None or date_to is None:
        return df
    return df.filter(F.col(column).between(F.lit(date_from), F.lit(date_to)))


def since(df: DataFrame, moment: Column, as_of: datetime, days: int) -> DataFrame:
    """Rows at most `days` before `as_of`.

    A date counts as its midnight, so the day on which the window opens part-way is out.
    """
    opens = utc_naive(as_of) - timedelta(days=days)
    return df.filter(moment >= F.lit(opens.isoformat(sep=" ")).cast("timestamp_ntz"))


def watermark(target: DataFrame, column: str) -> Column | None:
    """Highest value loaded so far as a literal, or None for an empty target.

    Reads that column only. The value travels as text, so no driver time zone gets at it.
    """
    kind = target.schema[column].dataType.simpleString()
    highest = target.agg(F.max(column).cast("string")).first()[0]
    return None if highest is None else F.lit(highest).cast(kind)


def after_watermark(batch: DataFrame, moment: Column, mark: Column | None) -> DataFrame:
    """Rows at or after `mark`, a literal or scalar subquery; a missing or NULL mark keeps all.

    So does a row without a moment: it cannot be told to be old, and the keyed write makes reading
    it again harmless. The bound is inclusive, so the newest rows are read again; the keyed write removes the
    repetition. A literal folds to a plain comparison, which reaches the scan as a pushed filter.
    """
    if mark is None:
        return batch
    return batch.filter(moment.isNull() | (moment >= mark) | mark.isNull())


def recent_groups(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose `column` is among its `n` highest distinct values."""
    newest = df.select(column).distinct().orderBy(F.col(column).desc()).limit(n)
    return df.join(newest, column, "left_semi")
