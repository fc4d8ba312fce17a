"""The daily run on landed records: values of the first run, then what later runs change."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from landing import OTHER, REPO, SECOND, commit, records, write_landing, write_projects
from pyspark.sql import functions as F

from osspulse import schemas, upkeep
from osspulse.pipeline import (
    CHECK_RESULTS,
    ChecksFailed,
    is_backfill,
    load_state,
    raw_tables,
    register_views,
    run_day,
    staged,
)
from osspulse.plans import queries
from osspulse.quality.suites import mart_suites, run_suites, source_freshness
from osspulse.sinks import Layer, catalog_marts, tables
from osspulse.sources import fresh_table, has_marts

DAY_1, DAY_2 = datetime(2025, 3, 3, 4), datetime(2025, 3, 4, 4)


def download_log(spark, path, rows):
    """`(day, package, installer)` events in the partitioned log."""
    from osspulse.sources import read_download_log

    events = [(datetime.fromisoformat(d + "T12:00:00"), (p,), ((i,),), date.fromisoformat(d)) for d, p, i in rows]
    df = spark.createDataFrame(events, schemas.DOWNLOAD_LOG)
    df.write.mode("overwrite").partitionBy("dt").parquet(str(path))
    return read_download_log(spark, str(path))


def dicts(df):
    return [row.asDict() for row in df.collect()]


def drop_layers(spark):
    for layer in Layer:
        spark.sql(f"DROP DATABASE IF EXISTS {layer.value} CASCADE")


@pytest.fixture(scope="module", autouse=True)
def few_buckets():
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(upkeep, "PERSON_BUCKETS", 4)
        patched.setattr(tables, "INDEX_BUCKETS", 4)
        yield


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    drop_layers(spark)
    root = tmp_path_factory.mktemp("run")
    assert not has_marts(spark)
    projects = write_projects(root / "projects.csv", [(REPO, "lantern"), (OTHER, "")])
    log = download_log(
        spark,
        root / "log",
        [
            ("2025-03-01", "lantern", "pip"),
            ("2025-03-02", "lantern", "pip"),
            ("2025-03-02", "lantern", None),
            ("2025-03-02", "lantern", "bandersnatch"),
            ("2025-03-02", "driftwood", "pip"),
            ("2025-03-03", "lantern", "uv"),
        ],
    )
    first = records()
    write_landing(root / "a", first)
    # A second page of commits, and a repository that nobody tracks.
    write_landing(root / "a", {"commits": [commit("lamp-4", "otto", "2025-02-27T11:00:00Z")]}, page=2)
    write_landing(root / "a", {"commits": [commit("far-1", "zora", "2025-02-27T11:00:00Z")]}, "open/sea")
    counts_1 = run_day(spark, str(root / "a"), projects, DAY_1, log)
    marts = catalog_marts(spark)
    state = {"counts_1": dicts(counts_1), "marts_1": {name: dicts(marts[name]) for name in marts}}
    state["staged_1"] = {name: df.count() for name, df in staged(raw_tables(spark)).items()}
    state["checks"] = dicts(spark.table(CHECK_RESULTS))

    second = records()
    second["repositories"][0].update(stargazers_count=420, topics=["signals"], updated_at="2025-03-03T20:00:00Z")
    second["commits"] = [
        commit("knot-1", "otto", "2025-03-03T09:00:00Z", parents=2),
        commit("lamp-5", None, "2025-03-03T10:00:00Z", parents=0),
        commit("old-1", "eve", "2024-06-01T00:00:00Z"),
    ]
    second["pull_requests"][1].update(
        state="closed", merged_at="2025-03-04T00:30:00Z", updated_at="2025-03-04T00:30:00Z"
    )
    second["releases"].append({"id": 52, "tag_name": "draft", "name": None, "published_at": None})
    write_landing(root / "a", second, load_day=date(2025, 3, 4))
    counts_2 = run_day(spark, str(root / "a"), projects, DAY_2, log)
    state["counts_2"] = dicts(counts_2)
    state["marts_2"] = {name: dicts(marts[name]) for name in marts}
    state.update(root=root, projects=projects, log=log)
    yield state
    drop_layers(spark)


@pytest.fixture
def whole_plans(spark):
    """Plans whose scans are not shortened."""
    name = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    yield
    spark.conf.set(name, before)


def test_first_run_counts(two_days):
    counts = {row["table"]: row["n"] for row in two_days["counts_1"]}
    assert counts == {
        "repositories": 1,
        "commits": 4,
        "issues": 2,
        "pull_requests": 2,
        "releases": 2,
        "downloads": 1,
        "repositories__topics": 3,
        "commits__parents": 3,
        "issues__labels": 2,
        "pull_requests__labels": 1,
    }
    assert two_days["staged_1"]["stg_issues"] == 1
    assert two_days["staged_1"]["stg_commits"] == 4


def test_first_run_marts(two_days):
    marts = two_days["marts_1"]
    assert {row["username"] for row in marts["dim_contributors"]} == {"mira", "otto", "pilar", "quinn"}
    assert [row["topics"] for row in marts["dim_repositories"]] == ["Night-light,harbour,signals"]
    assert [row["time_to_close_hours"] for row in marts["fct_issues"]] == [51]
    assert sorted(row["time_to_merge_hours"] or -1 for row in marts["fct_pull_requests"]) == [-1, 51]
    assert {row["label_name"] for row in marts["dim_labels"]} == {"weather", "urgent", "optics"}
    assert len(marts["bridge_issue_labels"]) == 2
    labels = {row["label_key"] for row in marts["dim_labels"]}
    assert {row["label_key"] for row in marts["bridge_issue_labels"]} <= labels
    assert [(row["package"], row["date_key"], row["download_count"]) for row in marts["fct_daily_downloads"]] == [
        ("lantern", 20250302, 2)
    ]
    version = marts["dim_repositories"][0]
    assert (version["valid_from"], version["valid_to"]) == (date(1900, 1, 1), date(9999, 12, 31))
    for fact in ("fct_commits", "fct_pull_requests", "fct_issues", "fct_releases", "fct_daily_downloads"):
        assert {row["repository_key"] for row in marts[fact]} == {version["repository_key"]}
    assert len(marts["dim_dates"]) == 11_323


def test_checks_are_stored(two_days):
    checks = two_days["checks"]
    assert {row["layer"] for row in checks} == {"staging", "marts"}
    assert {row["status"] for row in checks} == {"pass"}


def test_second_run_opens_a_version(two_days):
    versions = sorted(two_days["marts_2"]["dim_repositories"], key=lambda row: row["valid_from"])
    assert [(v["topics"], v["valid_from"], v["valid_to"], v["is_current"]) for v in versions] == [
        ("Night-light,harbour,signals", date(1900, 1, 1), date(2025, 3, 4), False),
        ("signals", date(2025, 3, 4), date(9999, 12, 31), True),
    ]


def test_second_run_facts(two_days):
    marts = two_days["marts_2"]
    # The merge commit is left out; the backdated one is behind the global cursor.
    assert {row["commit_hash"] for row in marts["fct_commits"]} == {f"lamp-{i}" for i in range(1, 6)}
    assert [row["contributor_key"] for row in marts["fct_commits"] if row["commit_hash"] == "lamp-5"] == [None]
    assert sorted(row["time_to_merge_hours"] for row in marts["fct_pull_requests"]) == [51, 128]
    assert len(marts["fct_releases"]) == 2  # the draft is in raw only
    assert sorted((row["date_key"], row["stars"]) for row in marts["fct_repository_metrics"]) == [
        (20250303, 412),
        (20250304, 420),
    ]
    assert sorted((row["date_key"], row["download_count"]) for row in marts["fct_daily_downloads"]) == [
        (20250302, 2),
        (20250303, 1),
    ]


def test_second_run_reads_its_days_only(spark, two_days):
    """What landed on the first day is read again (the bound is inclusive), what landed before is not."""
    from osspulse.sources import read_endpoint

    tracked = spark.createDataFrame([(REPO,)], "repo string")
    df = read_endpoint(spark, str(two_days["root"] / "a"), "commits", date(2025, 3, 4), date(2025, 3, 4), tracked)
    scan = next(line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters: [")[1].split("], ")[0]
    assert "load_day" in filters and "2025-03-04" in filters
    assert {r["_loaded_at"] for r in df.collect()} == {datetime(2025, 3, 4)}
    assert set(load_state(spark).values()) == {date(2025, 3, 4)}


def test_schemas_and_checks(spark, two_days):
    marts = catalog_marts(spark)
    for name, schema in schemas.MARTS.items():
        assert {f.name: f.dataType for f in marts[name].schema} == {f.name: f.dataType for f in schema}
    results = dicts(run_suites(marts, mart_suites(marts)))
    assert {row["status"] for row in results} == {"pass"}, [r for r in results if r["status"] != "pass"]


def test_questions_run_on_stored_marts(spark, two_days):
    marts = catalog_marts(spark)
    kpis = dicts(queries.overview_kpis(marts, [REPO]))[0]
    assert (kpis["repos"], kpis["commits"], kpis["prs"], kpis["issues"], kpis["releases"]) == (1, 5, 2, 1, 2)
    assert kpis["stars"] == 420
    assert dicts(queries.release_gaps(marts, [REPO])) == [{"repository_name": REPO, "gap_days": 20}]
    nothing = dicts(queries.overview_kpis(marts, []))[0]
    assert nothing["commits"] == 0 and nothing["pr_merge_rate"] == 0.0


def test_date_range_prunes_partitions(spark, two_days, whole_plans):
    marts = catalog_marts(spark)
    first, last = date(2025, 2, 24), date(2025, 2, 25)
    df = queries.commits_per_month(marts, [REPO], first, last)
    assert [row["commits"] for row in df.collect()] == [2]
    for question, column in (
        (queries.commits_per_month, "date_key"),
        (queries.pr_throughput_monthly, "opened_date_key"),
        (queries.issue_resolution_monthly, "opened_date_key"),
    ):
        plan = question(marts, [REPO], first, last)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and f"{column}#" in line and "full_date" not in line]
        assert scans
        for scan in scans:
            filters = scan.split("PartitionFilters: [")[1]
            assert f"{column}#" in filters and ">= 20250224" in filters and "<= 20" in filters
    plan = queries.pr_velocity_monthly(marts, [REPO], first, last)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(merged_date_key,20250224)" in plan


def test_health_window_prunes_every_fact(spark, two_days):
    df = queries.health_components(catalog_marts(spark), datetime(2025, 3, 5), [REPO])
    row = dicts(df)[0]
    assert (row["commits_90d"], row["pr_merge_rate"], row["days_since_release"]) == (5, 1.0, 15)
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for column, start in (("committed_at", "20241205"), ("is_merged", "20240305"), ("is_closed", "20240305")):
        scan = next(line for line in plan if "FileScan" in line and column in line)
        assert "date_key" in scan.split("PartitionFilters: [")[1] and start in scan


def test_repeated_run_changes_nothing(spark, two_days):
    run_day(spark, str(two_days["root"] / "a"), two_days["projects"], DAY_2, two_days["log"])
    marts = catalog_marts(spark)
    for name in marts:
        key = lambda row: sorted(map(str, row.items()))
        assert sorted(dicts(fresh_table(spark, f"marts.{name}").select(marts[name].columns)), key=key) == sorted(two_days["marts_2"][name], key=key), name


def test_full_refresh_gives_the_same_facts(spark, two_days):
    run_day(spark, str(two_days["root"] / "a"), two_days["projects"], DAY_2, two_days["log"], full_refresh=True)
    marts = catalog_marts(spark)
    for name in ("fct_commits", "fct_releases"):
        key = lambda row: sorted(map(str, row.items()))
        assert sorted(dicts(fresh_table(spark, f"marts.{name}").select(marts[name].columns)), key=key) == sorted(two_days["marts_2"][name], key=key), name


def test_late_day_needs_backfill(spark, two_days):
    again = {"target_date": date(2025, 3, 1), "interval_end": datetime(2025, 3, 2)}
    landing, projects, log = str(two_days["root"] / "a"), two_days["projects"], two_days["log"]
    counts = run_day(spark, landing, projects, datetime(2025, 3, 5), log, **again)
    tables = {row["table"] for row in dicts(counts) if "__" not in row["table"]}
    assert tables == {"downloads"}  # landed records skipped
    days = lambda: {r["date_key"] for r in dicts(fresh_table(spark, "marts.fct_daily_downloads"))}
    assert spark.table("raw.downloads").filter(F.col("date") == "2025-03-01").count() == 1
    assert days() == {20250302, 20250303}
    run_day(spark, landing, projects, datetime(2025, 3, 5), log, backfill=True, **again)
    assert days() == {20250301, 20250302, 20250303}


def test_cursor_per_repository(spark, two_days):
    before = spark.table("raw.commits").count()
    root = two_days["root"]
    day = date(2025, 3, 6)
    write_landing(root / "a", {"commits": [commit("tie-1", "zed", "2021-01-01T00:00:00Z")]}, OTHER, day)
    write_landing(root / "a", {"repositories": [SECOND]}, OTHER, day)
    args = (spark, str(root / "a"), two_days["projects"], datetime(2025, 3, 6, 5))
    run_day(*args)
    assert fresh_table(spark, "raw.commits").count() == before
    run_day(*args, cursor_by=["_repo"])
    # The backdated commit of the first repository stays behind that one's cursor.
    assert fresh_table(spark, "raw.commits").count() == before + 1


def test_a_commit_without_a_date_stays(spark, two_days):
    root, day = two_days["root"], date(2025, 3, 7)
    undated = [commit("mist-1", "mira", None), commit("mist-2", "mira", "2025-03-06T12:00:00Z")]
    write_landing(root / "a", {"commits": undated}, load_day=day)
    args = (str(root / "a"), two_days["projects"])
    for hour in (1, 2, 3):
        run_day(spark, *args, datetime(2025, 3, 7, hour), enforce=False)
        rows = {r["commit_hash"]: r["date_key"] for r in dicts(fresh_table(spark, "marts.fct_commits"))}
        assert rows["mist-1"] is None and rows["mist-2"] == 20250306
    status = fresh_table(spark, CHECK_RESULTS).filter("`check` = 'not_null(date_key)' and table = 'fct_commits'")
    assert {r["status"] for r in status.filter("run_at like '2025-03-07%'").collect()} == {"error"}
    with pytest.raises(ChecksFailed, match="fct_commits: not_null"):
        run_day(spark, *args, datetime(2025, 3, 7, 4))


def test_equal_versions_go_by_landing(spark, two_days):
    root = two_days["root"]
    for i, (day, stars) in enumerate([(date(2025, 3, 8), 500), (date(2025, 3, 9), 300), (date(2025, 3, 9), 400)]):
        again = records()["repositories"]
        again[0].update(stargazers_count=stars, updated_at="2025-03-08T01:00:00Z")
        write_landing(root / "a", {"repositories": again}, load_day=day, page=i)
    run_day(spark, str(root / "a"), two_days["projects"], datetime(2025, 3, 9, 4), enforce=False)
    row = fresh_table(spark, "raw.repositories").filter(F.col("id") == 4107).first()
    assert (row["stargazers_count"], row["_loaded_at"]) == (400, datetime(2025, 3, 9))


def test_a_duplicate_key_stops_the_run(spark, two_days, tmp_path):
    projects = write_projects(tmp_path / "twice.csv", [(REPO, "lantern"), (REPO, "buoy")])
    before = fresh_table(spark, "marts.fct_commits").count()
    with pytest.raises(ChecksFailed, match=r"projects: unique\(repo\)"):
        run_day(spark, str(two_days["root"] / "a"), projects, datetime(2025, 3, 10, 4))
    assert fresh_table(spark, "marts.fct_commits").count() == before


def test_backfill_rule():
    assert not is_backfill(datetime(2024, 1, 3), datetime(2024, 1, 2))
    assert not is_backfill(datetime(2024, 1, 3, 23), datetime(2024, 1, 2))
    assert is_backfill(datetime(2024, 1, 4), datetime(2024, 1, 2))


def test_views(spark, two_days):
    assert "stg_commits" in register_views(spark)
    assert spark.sql("select count(*) from contributor_activity").first()[0] > 0


def test_source_freshness(spark, two_days):
    # Repositories landed on the 9th at the latest, releases on the 4th.
    rows = source_freshness(raw_tables(spark), datetime(2025, 3, 9, 11)).collect()
    status = {row["table"]: row["status"] for row in rows}
    assert (status["repositories"], status["releases"]) == ("pass", "error")
