"""Checks counted by a write: their results, no further scan, and tables that stay as they were when one fails."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from osspulse.quality import checks
from osspulse.quality.guards import ChecksFailed, WriteGuard
from osspulse.quality.suites import write_guards
from osspulse.sinks import write_table

def suite():
    return [
        checks.row_count(1, 10),
        checks.not_null("id"),
        checks.between("v", 0, 5, severity="warn"),
        checks.expression("v <> 3"),
        checks.unique("id"),
    ]


@pytest.fixture(autouse=True)
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS g")
    yield
    spark.sql("DROP DATABASE g CASCADE")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, v int, day int").repartition(3)


def stored(spark):
    return sorted(tuple(r) for r in spark.table("g.x").select("id", "v", "day").collect())


def folders(spark):
    from pathlib import Path

    root = Path(spark.catalog.getDatabase("g").locationUri.removeprefix("file:"))
    return sorted(str(path) for path in root.rglob("*.parquet"))


@pytest.mark.parametrize("partition_by", [None, "day"])
def test_results_are_those_of_a_scan(spark, partition_by):
    df = frame(spark, (1, 9, 1), (2, None, 2), (3, 4, 2), (4, 7, None))
    guard = WriteGuard(suite())
    write_table(df, "g.x", partition_by=partition_by, guard=guard)
    scanned = {tuple(r) for r in checks.run_checks(spark.table("g.x"), suite()).collect()}
    assert set(guard.results()) == {r for r in scanned if not r[0].startswith("unique")}
    assert guard.rows == 4 and len(stored(spark)) == 4


@pytest.mark.parametrize("partition_by", [None, "day"])
def test_a_failed_check_leaves_the_table(spark, partition_by):
    bad = frame(spark, (None, 1, 1), (2, 3, 2))
    with pytest.raises(ChecksFailed, match="not_null"):
        write_table(bad, "g.x", partition_by=partition_by, guard=WriteGuard(suite()))
    assert not spark.catalog.tableExists("g.x") and not spark.catalog.tableExists("g.x__next")
    assert folders(spark) == []

    write_table(frame(spark, (1, 1, 1), (2, 2, 2)), "g.x", partition_by=partition_by, guard=WriteGuard(suite()))
    before, files = stored(spark), folders(spark)
    with pytest.raises(ChecksFailed, match="expression"):
        write_table(bad.fillna(7, ["id"]), "g.x", partition_by=partition_by, guard=WriteGuard(suite()))
    with pytest.raises(ChecksFailed, match="row_count"):
        write_table(bad.limit(0), "g.x", partition_by=partition_by, guard=WriteGuard(suite()))
    with pytest.raises(ChecksFailed, match="not_null"):
        write_table(bad.withColumn("more", F.lit(1)), "g.x", partition_by=partition_by, guard=WriteGuard(suite()))
    assert stored(spark) == before and folders(spark) == files

    write_table(frame(spark, (5, 1, 3)), "g.x", partition_by=partition_by, guard=WriteGuard(suite()))
    assert stored(spark) == [(5, 1, 3)]


def test_guards_of_the_marts(spark):
    guards = write_guards()
    assert all(check.row_fails is not None or check.bounds is not None for suite in guards.values() for check in suite)
    assert "not_null(commit_key)" in {check.name for check in guards["fct_commits"]}
