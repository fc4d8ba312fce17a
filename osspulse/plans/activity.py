"""Contributor activity events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from osspulse.functions import month_start

ACTIVITY_TYPES = ("commit", "pr_opened", "pr_merged", "issue_opened", "issue_closed")


def _two_step(rows: DataFrame, opened: str, finished_at: str, finished: str) -> DataFrame:
    """Opening and finishing event of each row in one pass over the rows.

    Both are credited to the author, whoever merged or closed.
    """

    def event(moment: str, kind: str):
        return F.struct(F.to_date(moment).alias("event_date"), F.lit(kind).alias("activity_type"))

    happened = F.array_compact(
        F.array(
            event("created_at", opened),
            F.when(F.col(finished_at).isNotNull(), event(finished_at, finished)),
        )
    )
    return rows.select(F.col("author_login").alias("username"), "repository", F.inline(happened))


def login_events(commits: DataFrame, pull_requests: DataFrame, issues: DataFrame) -> DataFrame:
    """One row per event of a known login: `username, activity_type, repository, event_date`."""
    known = F.col("author_login").isNotNull()
    events = (
        commits.filter(known)
        .select(
            F.col("author_login").alias("username"),
            "repository",
            F.to_date("committed_at").alias("event_date"),
            F.lit("commit").alias("activity_type"),
        )
        .unionByName(_two_step(pull_requests.filter(known), "pr_opened", "merged_at", "pr_merged"))
        .unionByName(_two_step(issues.filter(known), "issue_opened", "closed_at", "issue_closed"))
    )
    return events.select("username", "activity_type", "repository", "event_date")


def contributor_activity(
    commits: DataFrame, pull_requests: DataFrame, issues: DataFrame
) -> DataFrame:
    """One row per event of a known login: `username, event_date, event_month, activity_type`."""
    return login_events(commits, pull_requests, issues).select(
        "username", "event_date", month_start(F.col("event_date")).alias("event_month"), "activity_type"
    )
