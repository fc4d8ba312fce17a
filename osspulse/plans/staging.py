"""Staging: raw records cleaned to flat rows. No joins: lists stay with their parent in raw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osspulse.operators.nested import child_rows


def sorted_text(values: str, separator: str = ",") -> Column:
    """List elements in text order as one string; NULL when there are none."""
    present = F.array_compact(values)
    return F.when(F.array_size(present) > 0, F.array_join(F.array_sort(present), separator))


def stg_repositories(repositories: DataFrame) -> DataFrame:
    """One row per repository. Topics become one sorted string, a stable value to compare."""
    return repositories.select(
        F.col("id").alias("repository_id"),
        F.col("full_name").alias("repository_name"),
        "name",
        F.col("owner.login").alias("owner_login"),
        "description",
        F.col("stargazers_count").alias("stars"),
        F.col("forks_count").alias("forks"),
        F.col("open_issues_count").alias("open_issues"),
        "language",
        F.col("license.spdx_id").alias("license_spdx"),
        sorted_text("topics").alias("topics"),
        "created_at",
        "updated_at",
        "_loaded_at",
    )


def stg_commits(commits: DataFrame) -> DataFrame:
    """One row per commit with at most one parent: merges are left out, root commits stay."""
    parents = F.coalesce(F.array_size("parents"), F.lit(0))
    return commits.filter(parents <= 1).select(
        F.col("sha").alias("commit_sha"),
        F.col("_repo").alias("repository"),
        F.col("author.login").alias("author_login"),
        F.col("commit.author.name").alias("author_name"),
        F.col("commit.author.email").alias("author_email"),
        F.col("commit.author.date").alias("committed_at"),
        F.col("commit.message").alias("message"),
        "_loaded_at",
    )


def _true_issues(issues: DataFrame) -> DataFrame:
    return issues.filter(F.col("pull_request.url").isNull())


def stg_issues(issues: DataFrame) -> DataFrame:
    """One row per issue; records that are pull requests are left out."""
    return _true_issues(issues).select(
        F.col("_repo").alias("repository"),
        F.col("number").alias("issue_number"),
        F.col("user.login").alias("author_login"),
        "state",
        "created_at",
        "closed_at",
        F.col("comments").alias("comment_count"),
        "_loaded_at",
    )


def stg_pull_requests(pull_requests: DataFrame) -> DataFrame:
    return pull_requests.select(
        F.col("_repo").alias("repository"),
        F.col("number").alias("pr_number"),
        F.col("user.login").alias("author_login"),
        "state",
        "created_at",
        "merged_at",
        "_loaded_at",
    )


def _labels(parents: DataFrame, number: str, keep: Sequence[str] = ()) -> DataFrame:
    return child_rows(parents, "labels", ["_repo", "number", *keep]).select(
        F.col("_repo").alias("repository"),
        F.col("number").alias(number),
        F.col("name").alias("label_name"),
        F.col("color").alias("label_color"),
        *keep,
    )


def stg_issue_labels(issues: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per label on a true issue, with columns of the raw issue to `keep`."""
    return _labels(_true_issues(issues), "issue_number", keep)


def stg_pr_labels(pull_requests: DataFrame) -> DataFrame:
    """One row per label on a pull request."""
    return _labels(pull_requests, "pr_number")


def stg_releases(releases: DataFrame) -> DataFrame:
    """One row per release, drafts (no publish date) included."""
    return releases.select(
        F.col("id").alias("release_id"),
        F.col("_repo").alias("repository"),
        "tag_name",
        "name",
        "published_at",
        "_loaded_at",
    )


def stg_downloads(downloads: DataFrame) -> DataFrame:
    """One row per package and day. Text that is no date fails."""
    return downloads.select(
        F.col("_package").alias("package"),
        F.to_date("date").alias("download_date"),
        F.col("downloads").alias("download_count"),
        "_loaded_at",
    )
