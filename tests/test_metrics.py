"""Derived measures against brute force over random groups, and their invariants."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest

from osspulse.plans import dims, facts, metrics, queries


def share_of(spark, groups):
    rows = [(repo, f"u{i}", n) for repo, counts in groups.items() for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "repository_name string, username string, commits bigint")


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(3)
    made = {f"r{i}": [rng.choice([1, 1, 2, 3, 50]) for _ in range(rng.randint(1, 40))] for i in range(30)}
    return {**made, "even": [5, 5], "one": [9], "half": [2, 1, 1]}


def brute_bus_factor(counts):
    running, people = 0, 0
    for n in sorted(counts, reverse=True):
        running, people = running + n, people + 1
        if 2 * running >= sum(counts):
            return people


def test_bus_factor(spark, groups):
    got = dict(map(tuple, metrics.bus_factor(share_of(spark, groups)).collect()))
    assert got == {repo: brute_bus_factor(counts) for repo, counts in groups.items()}


def test_lorenz_curve(spark, groups):
    got = {}
    for repo, x, y in map(tuple, metrics.lorenz_curve(share_of(spark, groups)).collect()):
        got.setdefault(repo, []).append((x, y))
    for repo, counts in groups.items():
        running, expected = 0, [(0.0, 0.0)]
        for i, n in enumerate(sorted(counts), 1):
            running += n
            expected.append((i / len(counts), running / sum(counts)))
        points = sorted(got[repo])
        assert points == expected
        assert points[-1] == (1.0, 1.0)
        slopes = [b[1] - a[1] for a, b in zip(points, points[1:], strict=False)]
        assert all(b >= a - 1e-12 for a, b in zip(slopes, slopes[1:], strict=False))


def test_health_score(spark):
    components = spark.createDataFrame(
        [("full", 90, 1.0, 1.0, 0, 50_000), ("new", 0, 0.0, 0.0, None, 0), ("future", 0, 0.0, 0.0, -180, 0)],
        "repository_name string, commits_90d bigint, pr_merge_rate double, issue_close_rate double, "
        "days_since_release bigint, stars bigint",
    )
    scores = {row["repository_name"]: row["health_score"] for row in metrics.compute_health(components).collect()}
    assert scores["full"] == pytest.approx(100.0)
    assert scores["new"] == 0.0
    assert scores["future"] == pytest.approx(30.0)


@pytest.mark.parametrize(
    ("rows", "status"), [([], "none"), ([1, 1], "single"), ([None], "none"), ([1, 2], "trend")]
)
def test_series_status(spark, rows, status):
    df = spark.createDataFrame([(v,) for v in rows], "month int")
    assert metrics.series_status(df, "month").first()["status"] == status


def test_histogram_shares_one_step(spark):
    gaps = spark.createDataFrame(
        [("a", 0, 2), ("a", 399, 1), ("b", 15, 4)], "repository_name string, gap_days bigint, n bigint"
    )
    got = sorted(map(tuple, metrics.release_gap_histogram(gaps).collect()))
    assert got == [("a", 0, 2), ("a", 390, 1), ("b", 10, 4)]


def test_label_states_long(spark):
    df = spark.createDataFrame([("bug", 5, 3, 2)], "label_name string, issues bigint, open bigint, closed bigint")
    assert sorted(map(tuple, metrics.label_states_long(df).collect())) == [("bug", "closed", 2), ("bug", "open", 3)]


def test_release_gaps_with_repeated_days(spark):
    rng = random.Random(5)
    published = [datetime(2024, 1, rng.randint(1, 28), rng.randint(0, 23)) for _ in range(60)]
    fact = spark.createDataFrame([("k", at) for at in published], "repository_key string, published_at timestamp")
    versions = spark.createDataFrame([("k", "r")], "repository_key string, repository_name string")
    marts = {"fct_releases": fact, "dim_repositories": versions}
    got = sorted(row["gap_days"] for row in queries.release_gaps(marts).collect())
    days = sorted(published)
    assert got == sorted((b.date() - a.date()).days for a, b in zip(days, days[1:], strict=False))


def test_retention_invariants(spark):
    rng = random.Random(7)
    rows = {(f"c{rng.randint(0, 30)}", datetime(2023, rng.randint(1, 12), 1)) for _ in range(150)}
    fact = spark.createDataFrame(sorted(rows), "contributor_key string, event_month timestamp_ntz")
    marts = {"fct_contributor_activity_monthly": fact}
    cohorts = queries.retention_cohort(marts).collect()
    assert all(row["retention"] == 1.0 for row in cohorts if row["months_since"] == 0)
    assert all(0 < row["retention"] <= 1 for row in cohorts)
    monthly = queries.active_contributors_monthly(marts).collect()
    assert all(r["active"] == r["new_contributors"] + r["returning_contributors"] for r in monthly)
    assert sum(r["active"] for r in monthly) == len(rows)


def test_contributors_without_commits_have_zeros(spark):
    login = "author_login string, "
    commits = spark.createDataFrame(
        [("ann", "z/z", datetime(2024, 1, 2)), ("ann", "a/a", datetime(2024, 1, 1)), (None, "a/a", None)],
        login + "repository string, committed_at timestamp",
    )
    prs = spark.createDataFrame([("pat", None), ("pat", datetime(2024, 1, 1))], login + "merged_at timestamp")
    issues = spark.createDataFrame([("ida",), ("ann",), (None,)], "author_login string")
    rows = {r["username"]: r for r in dims.dim_contributors(commits, prs, issues).collect()}
    assert set(rows) == {"ann", "pat", "ida"}
    assert rows["ann"]["primary_project"] == "a/a"  # equal counts go by name
    assert (rows["ann"]["distinct_projects_count"], rows["ann"]["total_commits"]) == (2, 2)
    assert (rows["pat"]["total_prs_opened"], rows["pat"]["total_prs_merged"]) == (2, 1)
    assert rows["ida"]["first_commit_date"] is None and rows["ida"]["total_commits"] == 0


def test_same_label_in_two_colors(spark):
    schema = "label_name string, label_color string"
    issue_labels = spark.createDataFrame([("bug", "aa"), (None, "zz")], schema)
    pr_labels = spark.createDataFrame([("bug", "ff"), ("doc", None)], schema)
    rows = {r["label_name"]: r["label_color"] for r in dims.dim_labels(issue_labels, pr_labels).collect()}
    assert rows == {"bug": "ff", "doc": None}


def test_unmapped_package_keeps_its_row(spark):
    downloads = spark.createDataFrame(
        [("httpx", date(2024, 1, 1), 5), ("lost", date(2024, 1, 1), 6)],
        "package string, download_date date, download_count bigint",
    )
    projects = spark.createDataFrame([("e/h", "httpx"), ("e/x", None)], "repo string, package string")
    versions = spark.createDataFrame(
        [("k", "e/h", date(1900, 1, 1), date(9999, 12, 31))],
        "repository_key string, repository_name string, valid_from date, valid_to date",
    )
    rows = facts.fct_daily_downloads(downloads, projects, versions).collect()
    assert {r["package"]: r["repository_key"] for r in rows} == {"httpx": "k", "lost": None}


def test_events_outside_the_calendar_drop_out(spark):
    marts = {
        "fct_commits": spark.createDataFrame([("k", 19990101), ("k", 20240101)], "repository_key string, date_key int"),
        "dim_dates": dims.dim_dates(spark),
        "dim_repositories": spark.createDataFrame([("k", "r")], "repository_key string, repository_name string"),
    }
    assert [tuple(r) for r in queries.commits_per_month(marts).collect()] == [(datetime(2024, 1, 1), "r", 1)]
