"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from osspulse.operators import scd2_join
from osspulse.plans import dims
from workload import mapping
from workload.mapping import Tables
from workload.marts import LazyMarts
from workload.registry import REGISTRY

QUERIES = REGISTRY


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join_no_global_window(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert operator not in plan, operator
    for window in re.findall(r"(?:Window|WindowGroupLimit) \[.*", plan):
        # `Window [functions], [partition keys], [order]`
        assert re.search(r"\], \[[^\]]+#", window), window


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["commits_per_month"](spark, sf_dir))
    lineitem = next(line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line)
    for unread in ("l_extendedprice", "l_partkey", "l_tax"):
        assert unread not in lineitem


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["keyed_upsert"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate", plan)


def test_small_versions_are_broadcast(spark, sf_dir):
    df = LazyMarts(spark, sf_dir)["fct_commits"]
    df.collect()  # their size is known when they have been derived
    plan = plan_of(df)
    join = next(line for line in plan.splitlines() if "_version_name" in line and "Join" in line)
    assert "BroadcastHashJoin" in join and "LeftOuter" in join


def test_large_versions_join_by_key_with_residual_range(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, sf_dir)
        versions = dims.dim_repositories(mapping.history(t))
        pulls = mapping.pull_requests(t)
        plan = plan_of(scd2_join(pulls, versions, pulls["repository"], pulls["created_at"].cast("date")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in plan.splitlines() if "_version_name" in line and "Join" in line)
    assert "SortMergeJoin" in join and "_version_from" in join


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["commits_per_month"](spark, sf_dir))
    assert "partial_count" in plan


def test_retention_shuffles_contributor_months_once(spark):
    from datetime import datetime

    from osspulse.plans import queries

    fact = spark.createDataFrame([("a", datetime(2024, 1, 1))], "contributor_key string, event_month timestamp_ntz")
    plan = plan_of(queries._active_months({"fct_contributor_activity_monthly": fact}))
    assert plan.count("Exchange hashpartitioning(contributor_key") == 1
    assert plan.count("Exchange") == 1


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["month", "repository_name", "median_merge_hours"]
    assert df.count() > 0


def test_hot_repository_is_split_at_run_time(spark):
    """One name with half of the rows: the skew rule cuts its partition in the versions join."""
    from pyspark.sql import functions as F

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        names = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 500))
        facts = spark.range(0, 40_000, 1, 8).select(
            "id", names.alias("repo"), F.lit("2024-01-01").cast("date").alias("day")
        )
        versions = facts.select(
            F.md5("repo").alias("repository_key"),
            F.col("repo").alias("repository_name"),
            F.lit("1900-01-01").cast("date").alias("valid_from"),
            F.lit("9999-12-31").cast("date").alias("valid_to"),
        ).distinct()
        df = scd2_join(facts, versions, F.col("repo"), F.col("day"))
        assert len(df.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in plan_of(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
