"""Business questions over the marts.

`marts` maps mart names to frames (see `osspulse.sinks.catalog_marts` for stored ones). `repos`
is a list of repository names, a one-column frame of names, or None for all of them.

Facts are reduced to counts per key *before* they meet a dimension. The reduction starts inside the
scan tasks, so a repository, person or label with a large share of the rows reaches the shuffle as
a handful of rows, and the joins work on counts. The calendar is broadcast: it holds one row per
day, which bounds it.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from osspulse.functions import day_diff, month_diff, month_start, share_of_true, utc_naive
from osspulse.operators.filters import Repos, by_dates, by_repos, since
from osspulse.operators.latest import latest_per_key
from osspulse.operators.runs import expand_runs, weighted_median

Marts = Mapping[str, DataFrame]


# ----- shared steps -----
def _versions(marts: Marts, repos: Repos) -> DataFrame:
    """Version key to repository name, for the chosen repositories."""
    names = marts["dim_repositories"].select("repository_key", "repository_name")
    return by_repos(names, repos)


def _days(marts: Marts, key: str, date_from: date | None = None, date_to: date | None = None) -> DataFrame:
    days = marts["dim_dates"].select(F.col("date_key").alias(key), "full_date")
    return F.broadcast(by_dates(days, "full_date", date_from, date_to))


def _months(marts: Marts, key: str, date_from: date | None, date_to: date | None) -> DataFrame:
    days = _days(marts, key, date_from, date_to)
    return F.broadcast(days.select(key, month_start(F.col("full_date")).alias("month")))


def _between(fact: DataFrame, key: str, date_from: date | None, date_to: date | None) -> DataFrame:
    """Rows whose day key lies in the range: implied by the join with the days, but known to the scan."""
    if date_from is None or date_to is None:
        return fact
    low, high = (int(day.strftime("%Y%m%d")) for day in (date_from, date_to))
    return fact.filter(F.col(key).between(low, high))


def _recent(fact: DataFrame, key: str, as_of: datetime, days: int) -> DataFrame:
    """Rows whose day key can fall into the last `days` days.

    Implied by the exact condition on the moment or date, and in terms of the stored key, so that
    it prunes partitions and row groups.
    """
    opens = utc_naive(as_of) - timedelta(days=days)
    return fact.filter(F.col(key) >= int(opens.strftime("%Y%m%d")))


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint"))


# ----- overview -----
def all_repo_names(marts: Marts) -> DataFrame:
    """Current repository names, sorted."""
    current = marts["dim_repositories"].filter("is_current")
    return current.select("repository_name").orderBy(F.asc_nulls_last("repository_name"))


def overview_kpis(marts: Marts, repos: Repos = None) -> DataFrame:
    """One row of headline numbers.

    The counts of all facts, per version, meet the chosen versions in one join.
    """
    chosen = _versions(marts, repos)
    n, none = F.count("*").alias("n"), F.lit(None).cast("bigint")

    def rated(fact: str, flag: str) -> DataFrame:
        flags = (F.count_if(flag).alias("yes"), F.count(flag).alias("known"))
        return marts[fact].groupBy("repository_key").agg(n, *flags)

    per_version = {
        "commits": marts["fct_commits"].groupBy("repository_key", "contributor_key").agg(n),
        "prs": rated("fct_pull_requests", "is_merged"),
        "issues": rated("fct_issues", "is_closed"),
        "releases": marts["fct_releases"].groupBy("repository_key").agg(n),
    }
    facts = None
    for name, counts in per_version.items():
        people = "contributor_key" if name == "commits" else F.lit(None).cast("string").alias("contributor_key")
        flags = ("yes", "known") if "yes" in counts.columns else (none.alias("yes"), none.alias("known"))
        part = counts.select(F.lit(name).alias("fact"), "repository_key", people, "n", *flags)
        facts = part if facts is None else facts.unionByName(part)

    def of(fact: str, column: str) -> Column:
        return F.sum(F.when(F.col("fact") == fact, F.col(column)))

    def rate(fact: str) -> Column:
        return F.coalesce(share_of_true(of(fact, "yes"), of(fact, "known")), F.lit(0.0))

    metrics = by_repos(marts["fct_repository_metrics"], repos)
    newest = latest_per_key(
        metrics, ["repository_name"], ["date_key", "metric_key"], ["stars", "forks"]
    ).agg(F.struct(_zero(F.sum("stars")).alias("stars"), _zero(F.sum("forks")).alias("forks")))
    newest = newest.scalar()
    known = facts.join(chosen.select("repository_key"), "repository_key", "left_semi")
    return known.agg(
        _zero(of("commits", "n")).alias("commits"),
        F.count_distinct("contributor_key").alias("contributors"),
        _zero(of("prs", "n")).alias("prs"),
        rate("prs").alias("pr_merge_rate"),
        _zero(of("issues", "n")).alias("issues"),
        rate("issues").alias("issue_close_rate"),
        _zero(of("releases", "n")).alias("releases"),
    ).select(
        chosen.agg(F.count_distinct("repository_name")).scalar().alias("repos"),
        "*",
        newest["stars"].alias("stars"),
        newest["forks"].alias("forks"),
    )


def repo_snapshot(marts: Marts, repos: Repos = None) -> DataFrame:
    """Attributes and newest metrics of each current repository, most stars first."""
    measures = ["stars", "forks", "open_issues"]
    newest = latest_per_key(
        by_repos(marts["fct_repository_metrics"], repos),
        ["repository_name"],
        ["date_key", "metric_key"],
        measures,
    )
    current = by_repos(marts["dim_repositories"].filter("is_current"), repos)
    return (
        current.join(newest, "repository_name", "left")
        .select("repository_name", "language", "license_spdx", "topics", "created_at", *measures)
        .orderBy(F.desc_nulls_last("stars"), F.asc_nulls_last("repository_name"))
    )


def commits_per_month(
    marts: Marts, repos: Repos = None, date_from: date | None = None, date_to: date | None = None
) -> DataFrame:
    counted = (
        _between(marts["fct_commits"], "date_key", date_from, date_to)
        .join(_months(marts, "date_key", date_from, date_to), "date_key")
        .groupBy("repository_key", "month")
        .agg(F.count("*").alias("n"))
    )
    return (
        counted.join(_versions(marts, repos), "repository_key")
        .groupBy("month", "repository_name")
        .agg(F.sum("n").alias("commits"))
        .orderBy("month", F.asc_nulls_last("repository_name"))
    )


# ----- popularity and health -----
def stars_forks_over_time(marts: Marts, repos: Repos = None) -> DataFrame:
    metrics = by_repos(marts["fct_repository_metrics"], repos)
    return (
        metrics.join(_days(marts, "date_key"), "date_key")
        .select(F.col("full_date").alias("date"), "repository_name", "stars", "forks", "open_issues")
        .orderBy("date", F.asc_nulls_last("repository_name"))
    )


def downloads_over_time(marts: Marts, repos: Repos = None) -> DataFrame:
    """Downloads per day and package; packages without a chosen repository drop out."""
    chosen = _versions(marts, repos).select("repository_key")
    return (
        marts["fct_daily_downloads"]
        .join(_days(marts, "date_key"), "date_key")
        .join(chosen, "repository_key")
        .select(F.col("full_date").alias("date"), "package", F.col("download_count").alias("downloads"))
        .orderBy("date", F.asc_nulls_last("package"))
    )


def downloads_vs_stars(marts: Marts, repos: Repos = None) -> DataFrame:
    """Newest stars of each repository beside its downloads on the newest download day."""
    stars = latest_per_key(
        by_repos(marts["fct_repository_metrics"], repos),
        ["repository_name"],
        ["date_key", "metric_key"],
        ["stars"],
    )
    # Newest per version first, then per name; of two packages on that day the last in text order.
    order, take = ["date_key", "package"], ["date_key", "package", "download_count"]
    per_version = latest_per_key(
        marts["fct_daily_downloads"].filter(F.col("repository_key").isNotNull()),
        ["repository_key"],
        order,
        take,
    )
    named = per_version.join(_versions(marts, repos), "repository_key")
    downloads = latest_per_key(named, ["repository_name"], order, ["download_count"])
    return stars.join(downloads, "repository_name", "left").select(
        "repository_name", "stars", _zero(F.col("download_count")).alias("downloads")
    )


def health_components(marts: Marts, as_of: datetime, repos: Repos = None) -> DataFrame:
    """Per current repository the raw inputs of the health score, as seen at `as_of`."""
    versions = _versions(marts, repos)

    def named(per_version: DataFrame, *sums: Column) -> DataFrame:
        joined = per_version.join(versions, "repository_key")
        return joined.groupBy("repository_name").agg(*sums)

    commits = named(
        since(_recent(marts["fct_commits"], "date_key", as_of, 90), F.col("committed_at"), as_of, 90)
        .groupBy("repository_key")
        .agg(F.count("*").alias("n")),
        F.sum("n").alias("commits_90d"),
    )

    def yearly_rate(fact: str, flag: str, name: str) -> DataFrame:
        days = since(_days(marts, "opened_date_key"), F.col("full_date"), as_of, 365)
        counts = (
            _recent(marts[fact], "opened_date_key", as_of, 365)
            .join(F.broadcast(days.select("opened_date_key")), "opened_date_key")
            .groupBy("repository_key")
            .agg(F.count_if(flag).alias("yes"), F.count(flag).alias("known"))
        )
        return named(counts, share_of_true(F.sum("yes"), F.sum("known")).alias(name))

    last_release = named(
        marts["fct_releases"].groupBy("repository_key").agg(F.max("published_at").alias("last")),
        F.max("last").alias("last"),
    )
    stars = latest_per_key(
        by_repos(marts["fct_repository_metrics"], repos),
        ["repository_name"],
        ["date_key", "metric_key"],
        ["stars"],
    )
    base = by_repos(marts["dim_repositories"].filter("is_current"), repos).select("repository_name")
    parts = [
        commits,
        yearly_rate("fct_pull_requests", "is_merged", "pr_merge_rate"),
        yearly_rate("fct_issues", "is_closed", "issue_close_rate"),
        last_release,
        stars,
    ]
    for part in parts:
        base = base.join(part, "repository_name", "left")
    return base.select(
        "repository_name",
        _zero(F.col("commits_90d")).alias("commits_90d"),
        F.coalesce("pr_merge_rate", F.lit(0.0)).alias("pr_merge_rate"),
        F.coalesce("issue_close_rate", F.lit(0.0)).alias("issue_close_rate"),
        day_diff(F.col("last"), F.lit(utc_naive(as_of).date())).alias("days_since_release"),
        _zero(F.col("stars")).alias("stars"),
    ).orderBy(F.asc_nulls_last("repository_name"))


# ----- velocity -----
def pr_velocity_monthly(
    marts: Marts, repos: Repos = None, date_from: date | None = None, date_to: date | None = None
) -> DataFrame:
    """Median hours to merge by month of merging."""
    merged = _between(marts["fct_pull_requests"], "merged_date_key", date_from, date_to).filter("is_merged")
    counted = (
        merged.join(_months(marts, "merged_date_key", date_from, date_to), "merged_date_key")
        .groupBy("repository_key", "month", "time_to_merge_hours")
        .agg(F.count("*").alias("n"))
    )
    return (
        counted.join(_versions(marts, repos), "repository_key")
        .groupBy("month", "repository_name")
        .agg(weighted_median("time_to_merge_hours", "n").alias("median_merge_hours"))
        .orderBy("month", F.asc_nulls_last("repository_name"))
    )


def pr_throughput_monthly(
    marts: Marts, repos: Repos = None, date_from: date | None = None, date_to: date | None = None
) -> DataFrame:
    """Opened, merged and merge rate by month of opening."""
    counted = (
        _between(marts["fct_pull_requests"], "opened_date_key", date_from, date_to)
        .join(_months(marts, "opened_date_key", date_from, date_to), "opened_date_key")
        .groupBy("repository_key", "month")
        .agg(
            F.count("*").alias("n"),
            F.count_if("is_merged").alias("yes"),
            F.count("is_merged").alias("known"),
        )
    )
    return (
        counted.join(_versions(marts, repos), "repository_key")
        .groupBy("month", "repository_name")
        .agg(
            F.sum("n").alias("opened"),
            F.sum("yes").alias("merged"),
            share_of_true(F.sum("yes"), F.sum("known")).alias("merge_rate"),
        )
        .orderBy("month", F.asc_nulls_last("repository_name"))
    )


def issue_resolution_monthly(
    marts: Marts, repos: Repos = None, date_from: date | None = None, date_to: date | None = None
) -> DataFrame:
    """Median hours to close and close rate by month of opening."""
    counted = (
        _between(marts["fct_issues"], "opened_date_key", date_from, date_to)
        .join(_months(marts, "opened_date_key", date_from, date_to), "opened_date_key")
        .groupBy("repository_key", "month", "time_to_close_hours")
        .agg(
            F.count("*").alias("n"),
            F.count_if("is_closed").alias("yes"),
            F.count("is_closed").alias("known"),
        )
    )
    return (
        counted.join(_versions(marts, repos), "repository_key")
        .groupBy("month", "repository_name")
        .agg(
            weighted_median("time_to_close_hours", "n").alias("median_close_hours"),
            share_of_true(F.sum("yes"), F.sum("known")).alias("close_rate"),
        )
        .orderBy("month", F.asc_nulls_last("repository_name"))
    )


def issue_label_breakdown(marts: Marts, repos: Repos = None, limit: int = 15) -> DataFrame:
    """The labels on most issues, split by open and closed; equal counts go by name."""
    issues = marts["fct_issues"].select("issue_key", "repository_key", "is_closed")
    chosen = issues.join(
        _versions(marts, repos).select("repository_key"), "repository_key", "left_semi"
    )
    per_label = (
        marts["bridge_issue_labels"]
        .join(chosen, "issue_key")
        .groupBy("label_key")
        .agg(
            F.count("*").alias("n"),
            F.count_if(~F.col("is_closed")).alias("still_open"),
            F.count_if("is_closed").alias("done"),
        )
    )
    labels = marts["dim_labels"].select("label_key", "label_name")
    return (
        per_label.join(labels, "label_key")
        .groupBy("label_name")
        .agg(
            F.sum("n").alias("issues"),
            F.sum("still_open").alias("open"),
            F.sum("done").alias("closed"),
        )
        .orderBy(F.desc("issues"), F.asc_nulls_last("label_name"))
        .limit(limit)
    )


# ----- contributors -----
def _commits_by_person(marts: Marts, repos: Repos) -> DataFrame:
    """Attributed commits per contributor key and repository name."""
    attributed = marts["fct_commits"].filter(F.col("contributor_key").isNotNull())
    counted = attributed.groupBy("repository_key", "contributor_key").agg(F.count("*").alias("n"))
    return (
        counted.join(_versions(marts, repos), "repository_key")
        .groupBy("contributor_key", "repository_name")
        .agg(F.sum("n").alias("commits"))
    )


def _usernames(marts: Marts) -> DataFrame:
    return marts["dim_contributors"].select("contributor_key", "username")


def commit_share(marts: Marts, repos: Repos = None) -> DataFrame:
    """Commits per contributor and repository, attributed ones only."""
    return (
        _commits_by_person(marts, repos)
        .join(_usernames(marts), "contributor_key")
        .groupBy("repository_name", "username")
        .agg(F.sum("commits").alias("commits"))
    )


def contributor_leaderboard(marts: Marts, repos: Repos = None, limit: int = 20) -> DataFrame:
    """Most commits over the chosen repositories; equal counts go by name."""
    return (
        _commits_by_person(marts, repos)
        .join(_usernames(marts), "contributor_key")
        .groupBy("username")
        .agg(
            F.sum("commits").alias("commits"),
            F.count_distinct("repository_name").alias("projects"),
        )
        .orderBy(F.desc("commits"), F.asc_nulls_last("username"))
        .limit(limit)
    )


def _active_months(marts: Marts) -> DataFrame:
    """Distinct active months of each contributor with their first one as `cohort_month`.

    The fact already has one row per contributor and month, so combining before the shuffle would
    save nothing; one shuffle by contributor serves both the distinct and the window, and a
    contributor brings at most one row per calendar month.
    """
    months = marts["fct_contributor_activity_monthly"].select(
        "contributor_key", month_start(F.col("event_month")).alias("month")
    )
    first = F.min("month").over(Window.partitionBy("contributor_key"))
    return (
        months.filter(F.col("contributor_key").isNotNull() & F.col("month").isNotNull())
        .repartition("contributor_key")
        .distinct()
        .withColumn("cohort_month", first)
    )


def retention_cohort(marts: Marts) -> DataFrame:
    """Share of each first-active month's contributors active N months later, over all repositories.

    A contributor appears once per month, so plain counts are distinct counts, and a cohort's size
    is its count at month zero.
    """
    counted = (
        _active_months(marts)
        .withColumn("months_since", month_diff(F.col("cohort_month"), F.col("month")))
        .groupBy("cohort_month", "months_since")
        .agg(F.count("*").alias("active"))
    )
    at_start = F.when(F.col("months_since") == 0, F.col("active"))
    size = F.max(at_start).over(Window.partitionBy("cohort_month"))
    return (
        counted.withColumn("cohort_size", size)
        .withColumn("retention", F.col("active").cast("double") / F.col("cohort_size"))
        .orderBy("cohort_month", "months_since")
    )


def active_contributors_monthly(marts: Marts) -> DataFrame:
    """Active contributors per month, new against returning, over all repositories."""
    return (
        _active_months(marts)
        .groupBy("month")
        .agg(
            F.count("*").alias("active"),
            F.count_if(F.col("month") == F.col("cohort_month")).alias("new_contributors"),
            F.count_if(F.col("month") > F.col("cohort_month")).alias("returning_contributors"),
        )
        .orderBy("month")
    )


def multi_project_contributors(marts: Marts) -> DataFrame:
    """Contributors with commits in more than one project."""
    return (
        marts["dim_contributors"]
        .filter(F.col("distinct_projects_count") > 1)
        .select(
            "username",
            "total_commits",
            "total_prs_opened",
            "total_prs_merged",
            "distinct_projects_count",
            "primary_project",
        )
        .orderBy(F.desc("distinct_projects_count"), F.desc("total_commits"), "username")
    )


# ----- releases -----
def releases(marts: Marts, repos: Repos = None) -> DataFrame:
    return (
        marts["fct_releases"]
        .join(_versions(marts, repos), "repository_key")
        .select("repository_name", "tag_name", "release_name", "published_at")
        .orderBy(F.asc_nulls_last("published_at"))
    )


def release_gap_counts(marts: Marts, repos: Repos = None) -> DataFrame:
    """How often each gap in days between consecutive releases occurs: `n` per repository and gap.

    Counted by day first: releases on one day are zero days apart, and the first of a day follows
    the last release day before it. The window so holds the release days of one repository.
    """
    per_day = (
        marts["fct_releases"]
        .filter(F.col("published_at").isNotNull())
        .groupBy("repository_key", F.to_date("published_at").alias("day"))
        .agg(F.count("*").alias("n"))
        .join(_versions(marts, repos), "repository_key")
        .groupBy("repository_name", "day")
        .agg(F.sum("n").alias("n"))
    )
    before = F.lag("day").over(Window.partitionBy("repository_name").orderBy("day"))

    def gap(days: Column, count: Column) -> Column:
        return F.struct(days.alias("gap_days"), count.cast("bigint").alias("n"))

    gaps = F.array_compact(
        F.array(
            F.when(F.col("before").isNotNull(), gap(day_diff(F.col("before"), F.col("day")), F.lit(1))),
            F.when(F.col("n") > 1, gap(F.lit(0).cast("bigint"), F.col("n") - 1)),
        )
    )
    return (
        per_day.withColumn("before", before)
        .select("repository_name", F.inline(gaps))
        .groupBy("repository_name", "gap_days")
        .agg(F.sum("n").alias("n"))
    )


def release_gaps(marts: Marts, repos: Repos = None) -> DataFrame:
    """Days between consecutive releases, one row per pair."""
    runs = release_gap_counts(marts, repos)
    keys = ["repository_name", "gap_days"]
    return expand_runs(runs, "n", "_position", keys).select(*keys)


# ----- bounds -----
def date_bounds(marts: Marts) -> DataFrame:
    """First and last event day over commits, pull requests, issues and releases."""
    sources = [
        ("fct_commits", "date_key"),
        ("fct_pull_requests", "opened_date_key"),
        ("fct_issues", "opened_date_key"),
        ("fct_releases", "date_key"),
    ]
    keys = None
    for fact, column in sources:
        seen = marts[fact].select(F.col(column).alias("date_key")).distinct()
        keys = seen if keys is None else keys.unionByName(seen)
    return keys.join(_days(marts, "date_key"), "date_key").agg(
        F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day")
    )
