"""Derived measures: frames in, frames out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from osspulse.functions import clip_unit, half_life_decay, log_ratio, month_label
from osspulse.operators.filters import recent_groups
from osspulse.operators.runs import expand_runs, weighted_median

# Fixed values of the health score: what counts as fully healthy, the half-life of release
# recency in days, and the weights.
TARGET_COMMITS_90D = 90
REFERENCE_STARS = 50_000
RELEASE_HALF_LIFE_DAYS = 180.0
WEIGHTS = {
    "c_activity": 0.30,
    "c_pr_responsiveness": 0.20,
    "c_issue_management": 0.20,
    "c_release_recency": 0.15,
    "c_popularity": 0.15,
}

MAX_MONTHS_SINCE = 24
MAX_COHORTS = 36
MAX_BINS = 40


def compute_health(components: DataFrame) -> DataFrame:
    """Adds the five component scores (0..1) and `health_score` (0..100).

    A repository that never released has recency 0; a release dated after `as_of` scores above 1.
    """
    scored = components.withColumns(
        {
            "c_activity": log_ratio(F.col("commits_90d"), TARGET_COMMITS_90D),
            "c_pr_responsiveness": clip_unit(F.col("pr_merge_rate")),
            "c_issue_management": clip_unit(F.col("issue_close_rate")),
            "c_release_recency": half_life_decay(F.col("days_since_release"), RELEASE_HALF_LIFE_DAYS),
            "c_popularity": log_ratio(F.col("stars"), REFERENCE_STARS),
        }
    )
    total = sum((F.col(name) * weight for name, weight in WEIGHTS.items()), F.lit(0.0))
    return scored.withColumn("health_score", total * 100.0)


def _commit_runs(share: DataFrame) -> DataFrame:
    """`people` per repository and number of commits.

    A repository has few distinct commit counts (d of them need d(d+1)/2 commits), so the ordered
    sums below stay small for any number of contributors.
    """
    return share.groupBy("repository_name", "commits").agg(F.count("*").alias("people"))


def bus_factor(share: DataFrame) -> DataFrame:
    """Fewest top contributors of each repository with at least half of its commits."""
    per_repo = Window.partitionBy("repository_name")
    ahead = per_repo.orderBy(F.desc("commits")).rowsBetween(Window.unboundedPreceding, -1)
    volume = F.col("commits") * F.col("people")
    runs = _commit_runs(share).withColumns(
        {
            "total": F.sum(volume).over(per_repo),
            "before": F.coalesce(F.sum(volume).over(ahead), F.lit(0)),
        }
    )
    # Of the people with this many commits, those whose running sum is still below half.
    short_by = F.col("total") - 2 * F.col("before")
    below = F.when(short_by > 0, F.least("people", F.floor((short_by - 1) / (2 * F.col("commits")))))
    return runs.groupBy("repository_name").agg(
        (F.coalesce(F.sum(below), F.lit(0)) + 1).cast("bigint").alias("bus_factor")
    )


def lorenz_curve(share: DataFrame) -> DataFrame:
    """Cumulative share of commits held by the least active contributors, from (0, 0) to (1, 1)."""
    per_repo = Window.partitionBy("repository_name")
    behind = per_repo.orderBy("commits").rowsBetween(Window.unboundedPreceding, -1)
    volume = F.col("commits") * F.col("people")
    runs = _commit_runs(share).withColumns(
        {
            "all_people": F.sum("people").over(per_repo),
            "all_commits": F.sum(volume).over(per_repo),
            "people_before": F.sum("people").over(behind),
            "commits_before": F.sum(volume).over(behind),
        }
    )
    # The first run of a repository has nothing before it and also carries the origin.
    first = F.col("people_before").isNull()
    steps = runs.withColumns(
        {
            "steps": F.col("people") + F.when(first, 1).otherwise(0),
            "offset": F.when(first, 1).otherwise(0),
            "people_before": F.coalesce("people_before", F.lit(0)),
            "commits_before": F.coalesce("commits_before", F.lit(0)),
        }
    )
    points = expand_runs(steps, "steps", "step", ["repository_name", "commits"])
    person = F.col("step") - F.col("offset")
    people = (F.col("people_before") + person).cast("double")
    commits = (F.col("commits_before") + person * F.col("commits")).cast("double")
    return points.select(
        "repository_name",
        (people / F.col("all_people")).alias("contributor_frac"),
        (commits / F.col("all_commits")).alias("commit_frac"),
    )


def retention_heatmap(
    cohorts: DataFrame, max_months: int | None = MAX_MONTHS_SINCE, max_cohorts: int | None = MAX_COHORTS
) -> DataFrame:
    """`retention_cohort` with a `yyyy-MM` label, limited to the first months and the latest cohorts.

    None lifts a limit.
    """
    shown = cohorts if max_months is None else cohorts.filter(F.col("months_since") <= max_months)
    if max_cohorts is not None:
        shown = recent_groups(shown, "cohort_month", max_cohorts)
    return shown.withColumn("cohort", month_label(F.col("cohort_month")))


def release_cadence(gap_counts: DataFrame) -> DataFrame:
    """Median days between releases, from `release_gap_counts`."""
    return gap_counts.groupBy("repository_name").agg(weighted_median("gap_days", "n").alias("gap_days"))


def release_gap_histogram(gap_counts: DataFrame, max_bins: int = MAX_BINS) -> DataFrame:
    """Releases per repository and bin of gap days, from `release_gap_counts`.

    All repositories share one step: the smallest of 1, 2, 5, 10, 20, 50 ... days that needs at
    most `max_bins` bins from the shortest to the longest gap.
    """
    low, high = F.min("gap_days"), F.max("gap_days")
    # Up to the longest gap that a day count can hold.
    steps = [base * 10**power for power in range(10) for base in (1, 2, 5)]
    fitting = [
        F.when(F.floor(high / step) - F.floor(low / step) + 1 <= max_bins, F.lit(step).cast("bigint")) for step in steps
    ]
    step = gap_counts.agg(F.coalesce(*fitting).cast("bigint")).scalar()
    start = (F.floor(F.col("gap_days") / step) * step).cast("bigint")
    return gap_counts.groupBy("repository_name", start.alias("bin_start")).agg(
        F.sum("n").alias("releases")
    )


def label_states_long(breakdown: DataFrame) -> DataFrame:
    """Open and closed counts of `issue_label_breakdown` as rows."""
    return breakdown.unpivot(["label_name"], ["open", "closed"], "state", "issues")


def series_status(series: DataFrame, period: str) -> DataFrame:
    """One row: `none`, `single` (a point, no trend yet) or `trend`, by the distinct periods."""
    periods = F.count_distinct(period)
    status = F.when(periods >= 2, "trend").when(periods == 1, "single").otherwise("none")
    return series.agg(periods.alias("periods"), status.alias("status"))


def has_downloads(versus_stars: DataFrame) -> DataFrame:
    """One row: whether `downloads_vs_stars` has any downloads to correlate."""
    total = F.coalesce(F.sum("downloads"), F.lit(0).cast("bigint"))
    return versus_stars.agg(total.alias("downloads"), (total > 0).alias("ready"))
