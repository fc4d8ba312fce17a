"""Facts and the bridge.

`salts`: copies of a dimension over which the rows of a hot repository or login are split in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osspulse.functions import date_key, hour_diff, month_start, surrogate_key
from osspulse.operators.joins import lookup_join, scd2_join
from osspulse.plans.activity import ACTIVITY_TYPES


def _with_author(
    rows: DataFrame, contributors: DataFrame, key_name: str, spread_by: str, salts: int
) -> DataFrame:
    # Spread by a column that is read anyway.
    take = {"contributor_key": key_name}
    return lookup_join(rows, contributors, "author_login", "username", take, spread_by, salts)


def _hours(start: str, end: str) -> Column:
    return F.when(F.col(end).isNotNull(), hour_diff(F.col(start), F.col(end)))


def fct_commits(
    commits: DataFrame, repositories: DataFrame, contributors: DataFrame, salts: int = 1
) -> DataFrame:
    """One row per commit, at the repository version of the author date."""
    moment = F.col("committed_at")
    rows = scd2_join(commits, repositories, F.col("repository"), F.to_date(moment), salts=salts)
    rows = _with_author(rows, contributors, "contributor_key", "committed_at", salts)
    return rows.select(
        surrogate_key(F.col("repository"), F.col("commit_sha")).alias("commit_key"),
        "repository_key",
        "contributor_key",
        date_key(moment).alias("date_key"),
        F.col("commit_sha").alias("commit_hash"),
        "committed_at",
        "_loaded_at",
    )


def fct_pull_requests(
    pull_requests: DataFrame, repositories: DataFrame, contributors: DataFrame, salts: int = 1
) -> DataFrame:
    """One row per pull request, at the repository version of the opening day."""
    rows = scd2_join(pull_requests, repositories, F.col("repository"), F.to_date("created_at"), salts=salts)
    rows = _with_author(rows, contributors, "author_key", "created_at", salts)
    return rows.select(
        surrogate_key(F.col("repository"), F.col("pr_number")).alias("pr_key"),
        "repository_key",
        "author_key",
        date_key(F.col("created_at")).alias("opened_date_key"),
        date_key(F.col("merged_at")).alias("merged_date_key"),
        F.col("merged_at").isNotNull().alias("is_merged"),
        _hours("created_at", "merged_at").alias("time_to_merge_hours"),
    )


def fct_issues(
    issues: DataFrame, repositories: DataFrame, contributors: DataFrame, salts: int = 1
) -> DataFrame:
    """One row per issue. Closed goes by the state, the hours by the closing time."""
    rows = scd2_join(issues, repositories, F.col("repository"), F.to_date("created_at"), salts=salts)
    rows = _with_author(rows, contributors, "author_key", "created_at", salts)
    return rows.select(
        surrogate_key(F.col("repository"), F.col("issue_number")).alias("issue_key"),
        "repository_key",
        "author_key",
        date_key(F.col("created_at")).alias("opened_date_key"),
        date_key(F.col("closed_at")).alias("closed_date_key"),
        (F.col("state") == "closed").alias("is_closed"),
        _hours("created_at", "closed_at").alias("time_to_close_hours"),
        "comment_count",
    )


def fct_releases(releases: DataFrame, repositories: DataFrame, salts: int = 1) -> DataFrame:
    """One row per published release; drafts are left out."""
    published = releases.filter(F.col("published_at").isNotNull())
    rows = scd2_join(published, repositories, F.col("repository"), F.to_date("published_at"), salts=salts)
    return rows.select(
        surrogate_key(F.col("repository"), F.col("release_id")).alias("release_key"),
        "repository_key",
        date_key(F.col("published_at")).alias("date_key"),
        "tag_name",
        F.col("name").alias("release_name"),
        "published_at",
        "_loaded_at",
    )


def fct_daily_downloads(
    downloads: DataFrame, projects: DataFrame, repositories: DataFrame, salts: int = 1
) -> DataFrame:
    """One row per package and day; the repository is NULL for packages without one."""
    seed = projects.select(F.col("package").alias("_seed_package"), F.col("repo").alias("_seed_repo"))
    mapped = downloads.join(seed, F.col("package") == F.col("_seed_package"), "left")
    rows = scd2_join(mapped, repositories, F.col("_seed_repo"), F.col("download_date"), salts=salts)
    return rows.select(
        surrogate_key(F.col("package"), F.col("download_date")).alias("download_key"),
        "package",
        "repository_key",
        date_key(F.col("download_date")).alias("date_key"),
        "download_count",
    )


def fct_repository_metrics(repositories_now: DataFrame, repositories: DataFrame, salts: int = 1) -> DataFrame:
    """One row per repository and capture day: what the load saw of stars, forks, open issues."""
    captured = repositories_now.withColumn("capture_date", F.to_date("_loaded_at"))
    rows = scd2_join(captured, repositories, F.col("repository_name"), F.col("capture_date"), salts=salts)
    return rows.select(
        surrogate_key(F.col("repository_id"), F.col("capture_date")).alias("metric_key"),
        "repository_id",
        "repository_name",
        "repository_key",
        date_key(F.col("capture_date")).alias("date_key"),
        "stars",
        "forks",
        "open_issues",
    )


def _monthly(activity: DataFrame, contributors: DataFrame, count) -> DataFrame:
    names = ("commits", "prs_opened", "prs_merged", "issues_opened", "issues_closed")
    counts = [
        count(F.col("activity_type") == kind).alias(name)
        for kind, name in zip(ACTIVITY_TYPES, names, strict=True)
    ]
    monthly = activity.groupBy("username", "event_month").agg(*counts)
    people = contributors.select("username", "contributor_key")
    return monthly.join(people, "username").select(
        surrogate_key(F.col("contributor_key"), F.col("event_month")).alias("activity_key"),
        "contributor_key",
        "username",
        "event_month",
        date_key(F.col("event_month")).alias("month_date_key"),
        *names,
    )


def fct_contributor_activity_monthly(activity: DataFrame, contributors: DataFrame) -> DataFrame:
    """One row per contributor and month, a column per activity type.

    Counted before the join, so the join sees one row per login and month.
    """
    return _monthly(activity, contributors, F.count_if)


def activity_monthly_of_counts(counted: DataFrame, contributors: DataFrame) -> DataFrame:
    """The same from `n` events per username, activity_type and event_date."""
    months = counted.withColumn("event_month", month_start(F.col("event_date")))
    return _monthly(months, contributors, lambda kind: F.coalesce(F.sum(F.when(kind, F.col("n"))), F.lit(0)))


def bridge_issue_labels(issue_labels: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per issue and label, under the issue key of `fct_issues`, with columns of the issue to `keep`.

    `dim_labels` has every label name, and its key follows from the name: no join, so no hot label.
    """
    named = issue_labels.filter(F.col("label_name").isNotNull())
    pairs = named.select("repository", "issue_number", "label_name", *keep).distinct()
    issue = surrogate_key(F.col("repository"), F.col("issue_number"))
    return pairs.select(issue.alias("issue_key"), surrogate_key(F.col("label_name")).alias("label_key"), *keep)
