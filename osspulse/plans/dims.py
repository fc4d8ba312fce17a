"""Dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from osspulse.functions import (
    date_key,
    day_name,
    day_of_week,
    month_name,
    surrogate_key,
)
from osspulse.operators.history import OPEN_END
from osspulse.sources.calendar import date_spine

# The calendar's first day and (exclusive) end, and the start of the first version
# of a repository, early enough for every event before the first snapshot.
CALENDAR_START = date(2000, 1, 1)
CALENDAR_END = date(2031, 1, 1)
FIRST_VERSION_START = "1900-01-01"

# The attributes whose change opens a repository version.
VERSIONED_ATTRIBUTES = ("description", "language", "license_spdx", "topics")


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of the `full_date` rows."""
    day = F.col("full_date")
    weekday = day_of_week(day)
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        month_name(day).alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        weekday.alias("day_of_week"),
        day_name(day).alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.weekofyear(day).cast("bigint").alias("week_of_year"),
    )


def dim_dates(
    spark: SparkSession, first_day: date = CALENDAR_START, end_day: date = CALENDAR_END
) -> DataFrame:
    return calendar(date_spine(spark, first_day, end_day))


def dim_contributors(commits: DataFrame, pull_requests: DataFrame, issues: DataFrame) -> DataFrame:
    """One row per login seen in commits, pull requests or issues.

    Statistics come from commits and pull requests; someone who only opens issues has zeros. Each
    source is reduced on its own first, then one aggregate over the logins joins them up: no joins,
    and a login with a large share of the rows arrives as one row per project.
    """
    known = F.col("author_login").isNotNull()
    login = F.col("author_login").alias("username")
    day = F.to_date("committed_at")

    by_project = (
        commits.filter(known)
        .groupBy(login, "repository")
        .agg(
            F.count("*").alias("commits"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )
    )
    by_author = (
        pull_requests.filter(known)
        .groupBy(login)
        .agg(F.count("*").alias("opened"), F.count("merged_at").alias("merged"))
    )
    askers = issues.filter(known).select(login).distinct()

    people = by_project.unionByName(by_author, allowMissingColumns=True).unionByName(
        askers, allowMissingColumns=True
    )
    return _people(people)


def contributors_of_counts(counted: DataFrame) -> DataFrame:
    """`dim_contributors` from `n` events per username, activity_type, repository and event_date."""
    is_commit = F.col("activity_type") == "commit"
    day, n = F.when(is_commit, F.col("event_date")), F.col("n")
    by_project = counted.groupBy("username", "repository").agg(
        F.sum(F.when(is_commit, n)).alias("commits"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.sum(F.when(F.col("activity_type") == "pr_opened", n)).alias("opened"),
        F.sum(F.when(F.col("activity_type") == "pr_merged", n)).alias("merged"),
    )
    # A project counts where there are commits.
    return _people(by_project.withColumn("repository", F.when(F.col("commits").isNotNull(), F.col("repository"))))


def _people(people: DataFrame) -> DataFrame:
    # Most commits first, then the name in text order, a missing name last.
    rank = F.when(
        F.col("commits").isNotNull(),
        F.struct(
            (-F.col("commits")).alias("order"),
            F.col("repository").isNull().alias("unnamed"),
            F.col("repository").alias("project"),
        ),
    )
    zero = F.lit(0).cast("bigint")
    return (
        people.groupBy("username")
        .agg(
            F.min("first_day").alias("first_commit_date"),
            F.max("last_day").alias("last_commit_date"),
            F.coalesce(F.sum("commits"), zero).alias("total_commits"),
            F.coalesce(F.sum("opened"), zero).alias("total_prs_opened"),
            F.coalesce(F.sum("merged"), zero).alias("total_prs_merged"),
            F.count("repository").alias("distinct_projects_count"),
            F.min(rank).getField("project").alias("primary_project"),
        )
        .select(surrogate_key(F.col("username")).alias("contributor_key"), "*")
    )


def dim_repositories(history: DataFrame) -> DataFrame:
    """One row per repository version, with a half-open `[valid_from, valid_to)` in days.

    The key comes from the full version timestamp, so it stays unique when a repository changes
    twice on one day. The window holds the versions of one repository: one per snapshot run at most.
    """
    opened = F.col("dbt_valid_from")
    in_order = Window.partitionBy("repository_id").orderBy(opened)
    first_start = F.lit(FIRST_VERSION_START).cast("date")
    valid_from = F.when(F.row_number().over(in_order) == 1, first_start).otherwise(F.to_date(opened))
    valid_to = F.coalesce(F.to_date("dbt_valid_to"), F.lit(OPEN_END).cast("date"))
    return history.select(
        surrogate_key(F.col("repository_id"), opened).alias("repository_key"),
        "repository_id",
        "repository_name",
        "name",
        "owner_login",
        "description",
        "language",
        "license_spdx",
        "topics",
        "created_at",
        "updated_at",
        valid_from.alias("valid_from"),
        valid_to.alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
    )


def dim_labels(issue_labels: DataFrame, pr_labels: DataFrame) -> DataFrame:
    """One row per label name. Of several colors the last in text order is kept.

    Distinct pairs first: that is a hash aggregate which collapses almost everything in the map
    tasks, while a maximum over text has to sort its input.
    """
    columns = ["label_name", "label_color"]
    return labels_of(issue_labels.select(*columns).unionByName(pr_labels.select(*columns)))


def labels_of(pairs: DataFrame) -> DataFrame:
    """`dim_labels` from the pairs of name and color."""
    columns = ["label_name", "label_color"]
    return (
        pairs.select(*columns)
        .filter(F.col("label_name").isNotNull())
        .distinct()
        .groupBy("label_name")
        .agg(F.max("label_color").alias("label_color"))
        .select(surrogate_key(F.col("label_name")).alias("label_key"), *columns)
    )
