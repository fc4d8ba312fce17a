"""Readers."""

from osspulse.sources.calendar import date_spine, spine_between
from osspulse.sources.downloads import MIRROR_INSTALLERS, daily_downloads, read_download_log
from osspulse.sources.landed import (
    PAGE,
    attributed,
    landing_path,
    read_commits,
    read_endpoint,
    read_issues,
    read_pull_requests,
    read_releases,
    read_repositories,
    stamp,
    stream_endpoint,
)
from osspulse.sources.projects import read_projects, target_packages, target_repos
from osspulse.sources.tables import fresh_table, has_marts, table_or_empty

__all__ = [
    "MIRROR_INSTALLERS",
    "PAGE",
    "attributed",
    "daily_downloads",
    "date_spine",
    "fresh_table",
    "has_marts",
    "landing_path",
    "read_commits",
    "read_download_log",
    "read_endpoint",
    "read_issues",
    "read_projects",
    "read_pull_requests",
    "read_releases",
    "read_repositories",
    "spine_between",
    "stamp",
    "stream_endpoint",
    "table_or_empty",
    "target_packages",
    "target_repos",
]
