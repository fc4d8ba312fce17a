"""The marts over the mapped tables, derived on demand inside each query's plan."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse.plans import activity, dims, facts, staging
from osspulse.sources import daily_downloads
from workload import mapping
from workload.mapping import Tables

# The benchmark's events start in 1995, before the default calendar.
FIRST_DAY, END_DAY = date(1995, 1, 1), date(2031, 1, 1)


class LazyMarts(Mapping[str, DataFrame]):
    """Mart frames by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = _BUILDERS[name](self)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)


def _daily_downloads(m: LazyMarts) -> DataFrame:
    counted = daily_downloads(
        mapping.download_log(m.t),
        days=None,
        packages=None,
        package=F.col("project"),
        installer=F.col("installer"),
    )
    return counted.withColumn("_loaded_at", F.col("date").cast("timestamp"))


_BUILDERS: dict[str, Callable[[LazyMarts], DataFrame]] = {
    "raw_downloads": _daily_downloads,
    "contributor_activity": lambda m: activity.contributor_activity(
        mapping.commits(m.t), mapping.pull_requests(m.t), mapping.issues(m.t)
    ),
    "dim_dates": lambda m: dims.dim_dates(m.spark, FIRST_DAY, END_DAY),
    "dim_contributors": lambda m: dims.dim_contributors(
        mapping.commits(m.t), mapping.pull_requests(m.t), mapping.issues(m.t)
    ),
    "dim_repositories": lambda m: dims.dim_repositories(mapping.history(m.t)),
    "dim_labels": lambda m: dims.dim_labels(mapping.issue_labels(m.t), mapping.pr_labels(m.t)),
    "fct_commits": lambda m: facts.fct_commits(mapping.commits(m.t), m["dim_repositories"], m["dim_contributors"]),
    "fct_pull_requests": lambda m: facts.fct_pull_requests(
        mapping.pull_requests(m.t), m["dim_repositories"], m["dim_contributors"]
    ),
    "fct_issues": lambda m: facts.fct_issues(mapping.issues(m.t), m["dim_repositories"], m["dim_contributors"]),
    "fct_releases": lambda m: facts.fct_releases(mapping.releases(m.t), m["dim_repositories"]),
    "fct_daily_downloads": lambda m: facts.fct_daily_downloads(
        staging.stg_downloads(m["raw_downloads"]), mapping.projects(m.t), m["dim_repositories"]
    ),
    "fct_repository_metrics": lambda m: facts.fct_repository_metrics(
        mapping.repositories_now(m.t), m["dim_repositories"]
    ),
    "fct_contributor_activity_monthly": lambda m: facts.fct_contributor_activity_monthly(
        m["contributor_activity"], m["dim_contributors"]
    ),
    "bridge_issue_labels": lambda m: facts.bridge_issue_labels(mapping.issue_labels(m.t)),
}
