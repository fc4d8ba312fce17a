"""The checks of each table."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from osspulse.plans.activity import ACTIVITY_TYPES
from osspulse.quality.checks import (
    Check,
    accepted_values,
    adjacent_ranges,
    between,
    expression,
    freshness,
    not_null,
    relationships,
    row_count,
    run_checks,
    unique,
)

# Accepted sizes of a mart, and the age in hours of a source at which it warns and fails.
MIN_ROWS, MAX_ROWS = 1, 10_000_000
WARN_HOURS, ERROR_HOURS, DOWNLOADS_ERROR_HOURS = 12, 24, 48


def _key(column: str) -> list[Check]:
    return [not_null(column), unique(column)]


def _measure(column: str) -> list[Check]:
    return [not_null(column), expression(f"{column} >= 0")]


def mart_suites(
    marts: Mapping[str, DataFrame], min_rows: int = MIN_ROWS, max_rows: int | None = MAX_ROWS
) -> dict[str, list[Check]]:
    """Checks by mart. `max_rows=None` lifts the upper bound of a mart's size."""

    def _size(severity: str) -> Check:
        return row_count(min_rows, max_rows, severity)

    def fk(column: str, parent: str, parent_column: str) -> Check:
        return relationships(column, marts[parent], parent_column)

    repository = fk("repository_key", "dim_repositories", "repository_key")
    day = [not_null("date_key"), fk("date_key", "dim_dates", "date_key")]
    opened = [not_null("opened_date_key"), fk("opened_date_key", "dim_dates", "date_key")]
    author = fk("author_key", "dim_contributors", "contributor_key")

    def hours(column: str) -> Check:
        return between(column, 0, None, where=f"{column} is not null", severity="warn")

    return {
        "dim_dates": [_size("error"), *_key("date_key"), *_key("full_date")],
        "dim_contributors": [_size("error"), *_key("contributor_key"), *_key("username")],
        "dim_repositories": [
            _size("error"),
            adjacent_ranges("repository_id", "valid_from", "valid_to"),
            *_key("repository_key"),
            not_null("repository_id"),
            not_null("is_current"),
        ],
        "dim_labels": [_size("warn"), *_key("label_key"), *_key("label_name")],
        "fct_commits": [
            _size("error"),
            *_key("commit_key"),
            not_null("repository_key"),
            repository,
            fk("contributor_key", "dim_contributors", "contributor_key"),
            *day,
        ],
        "fct_pull_requests": [
            _size("warn"),
            *_key("pr_key"),
            not_null("repository_key"),
            repository,
            author,
            *opened,
            fk("merged_date_key", "dim_dates", "date_key"),
            hours("time_to_merge_hours"),
        ],
        "fct_issues": [
            _size("warn"),
            *_key("issue_key"),
            not_null("repository_key"),
            repository,
            author,
            *opened,
            fk("closed_date_key", "dim_dates", "date_key"),
            hours("time_to_close_hours"),
            *_measure("comment_count"),
        ],
        "fct_releases": [
            _size("warn"),
            *_key("release_key"),
            not_null("repository_key"),
            repository,
            *day,
        ],
        "bridge_issue_labels": [
            _size("warn"),
            unique("issue_key", "label_key"),
            not_null("issue_key"),
            fk("issue_key", "fct_issues", "issue_key"),
            not_null("label_key"),
            fk("label_key", "dim_labels", "label_key"),
        ],
        "fct_daily_downloads": [
            _size("error"),
            *_key("download_key"),
            not_null("package"),
            repository,
            *day,
            *_measure("download_count"),
        ],
        "fct_repository_metrics": [
            _size("error"),
            *_key("metric_key"),
            not_null("repository_key"),
            repository,
            *day,
            *_measure("stars"),
            *_measure("forks"),
            *_measure("open_issues"),
        ],
        "fct_contributor_activity_monthly": [
            _size("warn"),
            *_key("activity_key"),
            not_null("contributor_key"),
            fk("contributor_key", "dim_contributors", "contributor_key"),
            not_null("month_date_key"),
            fk("month_date_key", "dim_dates", "date_key"),
        ],
    }


def staging_suites() -> dict[str, list[Check]]:
    state = accepted_values("state", ["open", "closed"])
    return {
        "stg_repositories": [*_key("repository_id"), not_null("repository_name")],
        "stg_commits": [
            not_null("commit_sha"),
            not_null("repository"),
            unique("repository", "commit_sha"),
        ],
        "stg_pull_requests": [
            not_null("pr_number"),
            not_null("repository"),
            state,
            unique("repository", "pr_number"),
        ],
        "stg_issues": [
            not_null("issue_number"),
            not_null("repository"),
            state,
            unique("repository", "issue_number"),
        ],
        "stg_releases": [*_key("release_id"), not_null("repository")],
        "stg_issue_labels": [not_null("label_name")],
        "stg_pr_labels": [not_null("label_name")],
        "stg_downloads": [
            not_null("package"),
            not_null("download_date"),
            not_null("download_count"),
            unique("package", "download_date"),
        ],
        "contributor_activity": [
            not_null("username"),
            not_null("event_date"),
            not_null("event_month"),
            not_null("activity_type"),
            accepted_values("activity_type", list(ACTIVITY_TYPES)),
        ],
        "projects": [not_null("repo"), unique("repo"), unique("package")],
    }


def source_freshness(raw: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Age of every raw table; downloads may be a day older than the rest before they fail."""
    downloads = {name: df for name, df in raw.items() if name == "downloads"}
    others = {name: df for name, df in raw.items() if name != "downloads"}
    parts = [
        freshness(tables, as_of, WARN_HOURS, error)
        for tables, error in ((others, ERROR_HOURS), (downloads, DOWNLOADS_ERROR_HOURS))
        if tables
    ]
    return reduce(DataFrame.unionByName, parts)


def write_guards() -> dict[str, list[Check]]:
    """The checks of the marts that a `WriteGuard` can make; none of them reads another mart."""
    suites = mart_suites(defaultdict(lambda: None))
    return {
        name: [check for check in suite if check.row_fails is not None or check.bounds is not None]
        for name, suite in suites.items()
    }


def run_suites(tables: Mapping[str, DataFrame], suites: Mapping[str, list[Check]]) -> DataFrame:
    """`table, check, severity, violations, status` for every table that has checks."""
    parts = [
        run_checks(tables[name], suite).select(F.lit(name).alias("table"), "*")
        for name, suite in suites.items()
        if name in tables
    ]
    return reduce(DataFrame.unionByName, parts)
