"""Row numbers, the as-of join by ordered merge, and person bitmaps against plain loops; their plans."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from osspulse.operators.bitmaps import merge_bitmaps, numbered_persons, person_bitmaps, persons_in
from osspulse.operators.numbering import row_numbers
from osspulse.operators.ordered_asof import ordered_asof


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_numbers(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice([None, *range(50)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(partitions)
    numbered = row_numbers(df, [F.col("a").desc_nulls_last(), F.col("b").asc()])
    got = [(r.position, r.a, r.b) for r in numbered.collect()]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted(got) == [(i + 1, *r) for i, r in enumerate(want)]
    assert "Window" not in plan_of(numbered) and "Python" not in plan_of(numbered)
    assert row_numbers(df.limit(0), [F.col("a")]).collect() == []


def test_numbers_of_rows_as_they_stand(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(30)], "a int, b int").orderBy("a", F.col("b").desc())
    got = [(r.position, r.a, r.b) for r in row_numbers(df, (), is_sorted=True).orderBy("position").collect()]
    assert got == [(i + 1, *r) for i, r in enumerate(sorted(((i % 3, i) for i in range(30)), key=lambda r: (r[0], -r[1])))]


def asof_loops(events, versions):
    out = []
    for key, day, n in events:
        found = [v for k, a, b, v in versions if k == key and key is not None and day is not None and a <= day < b]
        out.append((key, day, n, found[0] if found else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_asof_against_loops(spark, seed):
    rng, start = random.Random(seed), date(2024, 1, 1)
    day = lambda n: start + timedelta(days=n)
    versions = []
    for key in "abc":
        at = rng.randint(0, 20)
        for i in range(rng.randint(0, 12)):
            # Gaps, and empty ranges where two versions open on one day.
            end = at + rng.choice((0, 1, 3, 9))
            versions.append((key, day(at), day(end), f"{key}{i}"))
            at = end + rng.choice((0, 0, 5))
    events = [(rng.choice(["a", "a", "a", "a", "b", "c", "z", None]), rng.choice([None, *map(day, range(90))]), n) for n in range(400)]
    left = spark.createDataFrame(events, "k string, at date, n int").repartition(5)
    right = spark.createDataFrame(versions, "name string, a date, b date, v string")
    found = ordered_asof(left, right, ["k"], "at", ["name"], "a", "b", ["v"])
    assert sorted(((r.k, r.at, r.n, r.v) for r in found.collect()), key=str) == asof_loops(events, versions)


def test_asof_without_versions_or_events(spark):
    left = spark.createDataFrame([("a", date(2024, 1, 1))], "k string, at date")
    right = spark.createDataFrame([], "name string, a date, b date, v string")
    assert [tuple(r) for r in ordered_asof(left, right, ["k"], "at", ["name"], "a", "b", ["v"]).collect()] == [("a", date(2024, 1, 1), None)]
    assert ordered_asof(left.limit(0), right, ["k"], "at", ["name"], "a", "b", ["v"]).collect() == []


def test_asof_over_partitions_without_versions(spark):
    start = date(2024, 1, 1)
    left = spark.createDataFrame([("a", start + timedelta(days=i), i) for i in range(4000)], "k string, at date, n int")
    right = spark.createDataFrame([("a", start, date(2100, 1, 1), "v"), ("b", start, date(2100, 1, 1), "w")], "name string, a date, b date, v string")
    found = ordered_asof(left, right, ["k"], "at", ["name"], "a", "b", ["v"])
    # What is open at the start of a partition is not found by comparing partitions with each other.
    assert "NestedLoopJoin" not in plan_of(found) and "CartesianProduct" not in plan_of(found)
    assert found.filter("v = 'v'").count() == found.count() == 4000


def test_one_name_with_many_versions_and_events(spark):
    versions = spark.range(20_000).select(
        F.lit("hot").alias("name"),
        F.date_add(F.lit("1970-01-01"), F.col("id").cast("int")).alias("a"),
        F.date_add(F.lit("1970-01-01"), (F.col("id") + 1).cast("int")).alias("b"),
        F.col("id").alias("v"),
    )
    events = spark.range(200_000).select(F.lit("hot").alias("k"), F.date_add(F.lit("1970-01-01"), (F.col("id") % 20_000).cast("int")).alias("at"), "id")
    found = ordered_asof(events, versions, ["k"], "at", ["name"], "a", "b", ["v"])
    assert found.filter(F.col("v") != F.col("id") % 20_000).count() == 0 and found.filter("v is not null").count() == 200_000
    # Only the partitions' open versions are joined, by broadcast; no version meets an event in a join.
    plan = plan_of(found)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_bitmaps_against_sets(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xyz"), rng.randint(1, 6), rng.choice([None, *(f"p{i}" for i in range(300))])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "repo string, month int, username string")
    numbers = numbered_persons(df)
    assert sorted(r.number for r in numbers.collect()) == list(range(1, 301))
    bitmaps = person_bitmaps(df, numbers, ["repo", "month"])
    sets = defaultdict(set)
    for repo, month, person in rows:
        if person:
            sets[repo, month].add(person)
    got = {(r.repo, r.month): r.contributors for r in persons_in(bitmaps, ["repo", "month"]).collect()}
    assert got == {k: len(v) for k, v in sets.items()}
    by_repo = {r.repo: r.contributors for r in persons_in(bitmaps, ["repo"]).collect()}
    assert by_repo == {repo: len(set().union(*(v for k, v in sets.items() if k[0] == repo))) for repo in "xyz"}
    ranged = persons_in(bitmaps.filter(F.col("month").between(2, 4)), []).first()[0]
    assert ranged == len(set().union(*(v for k, v in sets.items() if 2 <= k[1] <= 4)))
    assert persons_in(bitmaps.limit(0), []).first()[0] == 0


def test_bitmaps_of_a_second_load_add_to_stored_ones(spark):
    first = spark.createDataFrame([("x", 1, "b"), ("x", 1, "d")], "repo string, month int, username string")
    second = spark.createDataFrame([("x", 1, "a"), ("x", 1, "b"), ("x", 2, "c")], first.schema)
    numbers = numbered_persons(first)
    more = numbered_persons(second, numbers)
    old = {r.username: r.number for r in numbers.collect()}
    new = {r.username: r.number for r in more.collect()}
    assert old.items() <= new.items() and sorted(new.values()) == [1, 2, 3, 4]
    groups = ["repo", "month"]
    both = merge_bitmaps(person_bitmaps(first, numbers, groups).unionByName(person_bitmaps(second, more, groups)), groups)
    assert {(r.repo, r.month): r.contributors for r in persons_in(both, groups).collect()} == {("x", 1): 3, ("x", 2): 1}
    assert persons_in(both, []).first()[0] == 4


def test_persons_beyond_one_bucket(spark):
    df = spark.range(70_000).select(F.concat(F.lit("p"), "id").alias("username"), F.lit("x").alias("repo"))
    bitmaps = person_bitmaps(df.unionByName(df), numbered_persons(df), ["repo"])
    assert bitmaps.count() == 3 and persons_in(bitmaps, ["repo"]).first().contributors == 70_000
