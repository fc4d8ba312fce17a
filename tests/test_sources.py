from __future__ import annotations

from datetime import date, datetime

import pytest
from landing import LANDED, REPO, commit, records, write_landing, write_projects
from pyspark.sql import functions as F

from osspulse import schemas
from osspulse.plans import staging
from osspulse.sources import (
    PAGE,
    daily_downloads,
    date_spine,
    read_commits,
    read_download_log,
    read_issues,
    read_projects,
    read_repositories,
    stamp,
    target_packages,
    target_repos,
)

NOW = datetime(2024, 1, 10)


def test_projects(spark, tmp_path):
    path = write_projects(tmp_path / "p.csv", [("a/a", "a"), ("b/b", ""), ("", "c")])
    projects = read_projects(spark, path)
    assert {r[0] for r in target_repos(projects).collect()} == {"a/a", "b/b"}
    assert {r[0] for r in target_packages(projects).collect()} == {"a", "c"}
    assert read_projects(spark, str(tmp_path / "absent.csv")).count() == 0


def test_stamp_wins_over_record_fields(spark):
    df = spark.createDataFrame([("mine", 1)], "_repo string, v int")
    row = stamp(df, NOW, _repo="a/a").first()
    assert (row["_repo"], row["v"], row["_loaded_at"]) == ("a/a", 1, NOW)
    assert df.columns == ["_repo", "v"]


def test_landed_records(spark, tmp_path):
    write_landing(tmp_path, records())
    later = date(2025, 3, 5)
    write_landing(tmp_path, {"commits": [commit("zz", "zoe", "2024-01-01T00:00:00Z")]}, "other/one", later)
    commits = read_commits(spark, str(tmp_path))
    assert commits.schema.fieldNames() == [*schemas.RAW["commits"].fieldNames(), PAGE]
    assert {(r["_repo"], r["sha"], r["_loaded_at"].date()) for r in commits.collect()} == {
        *((REPO, f"lamp-{i}", LANDED) for i in (1, 2, 3)),
        ("other/one", "zz", later),
    }
    assert {r[PAGE]["file"] for r in commits.collect()} == {"page-1.json"}
    frame = spark.createDataFrame([("other/one",), ("no/one",)], "repo string")
    for repos in (["other/one"], frame):
        assert read_commits(spark, str(tmp_path), repos=repos).count() == 1
    assert read_commits(spark, str(tmp_path), repos=[]).count() == 0
    assert read_commits(spark, str(tmp_path), first_day=later).count() == 1
    assert read_commits(spark, str(tmp_path), last_day=LANDED).count() == 3
    assert read_repositories(spark, str(tmp_path)).first()["full_name"] == REPO


def test_response_pages(spark, tmp_path):
    write_landing(tmp_path, records(), multi_line=True)
    assert read_commits(spark, str(tmp_path), multi_line=True).count() == 3


def test_missing_fields_and_lists_are_null(spark, tmp_path):
    write_landing(tmp_path, {"issues": [{"number": 1, "state": "open"}]}, "a/a")
    row = staging.stg_issues(read_issues(spark, str(tmp_path))).first()
    assert (row["issue_number"], row["author_login"], row["closed_at"]) == (1, None, None)
    assert staging.stg_issue_labels(read_issues(spark, str(tmp_path))).count() == 0


def test_a_record_that_does_not_fit_fails(spark, tmp_path):
    write_landing(tmp_path, {"issues": [{"number": "many"}]}, "a/a")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        read_issues(spark, str(tmp_path)).collect()


@pytest.fixture
def log(spark, tmp_path):
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    rows = [
        (datetime(2024, 1, d.day, 5), (package,), ((installer,),), d)
        for d in days
        for package, installer in [("a", "pip"), ("a", None), ("a", "devpi"), ("b", "uv"), ("c", "Artifactory")]
    ]
    spark.createDataFrame(rows, schemas.DOWNLOAD_LOG).write.partitionBy("dt").parquet(str(tmp_path / "log"))
    return read_download_log(spark, str(tmp_path / "log"))


def test_daily_downloads(spark, log):
    counted = daily_downloads(log, date(2024, 1, 1), ["a", "c"])
    assert [tuple(r) for r in counted.collect()] == [("a", "2024-01-01", 2)]
    frame = spark.createDataFrame([("a",), ("b",)], "package string")
    assert daily_downloads(log, None, frame).count() == 4
    assert daily_downloads(log, date(2024, 1, 1), []).count() == 0


def test_daily_downloads_read_one_partition(log):
    plan = daily_downloads(log, date(2024, 1, 1), ["a"])._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    partition_filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "dt" in partition_filters and "2024-01-01" in partition_filters


def test_merge_commits_are_left_out_and_root_commits_stay(spark, tmp_path):
    landed = [commit(f"c{n}", "x", "2024-01-01T00:00:00Z", parents=n) for n in range(4)]
    landed.append({**commit("cn", "x", "2024-01-01T00:00:00Z"), "parents": None})
    write_landing(tmp_path, {"commits": landed})
    kept = staging.stg_commits(read_commits(spark, str(tmp_path)))
    assert {r["commit_sha"] for r in kept.collect()} == {"c0", "c1", "cn"}


def test_topics(spark):
    df = spark.createDataFrame([(["b", "B", "a", None],), ([],), (None,), ([None],)], "topics array<string>")
    got = [r[0] for r in df.select(staging.sorted_text("topics")).collect()]
    assert got == ["B,a,b", None, None, None]


def test_bad_download_date_fails(spark):
    df = spark.createDataFrame([("a", "soon", 1, NOW)], schemas.RAW_DOWNLOADS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
        staging.stg_downloads(df).collect()


def test_spine_end_is_exclusive(spark):
    spine = date_spine(spark, date(2024, 2, 28), date(2024, 3, 1))
    assert [r[0] for r in spine.orderBy("full_date").collect()] == [date(2024, 2, 28), date(2024, 2, 29)]
    assert date_spine(spark, date(2024, 1, 1), date(2024, 1, 1)).count() == 0
    assert date_spine(spark, date(2000, 1, 1), date(2031, 1, 1)).agg(F.count("*")).first()[0] == 11_323
