from __future__ import annotations

import random
import statistics
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from osspulse.operators import (
    after_watermark,
    by_dates,
    by_repos,
    child_rows,
    delete_insert,
    expand_runs,
    flatten_struct,
    latest_per_key,
    lookup_join,
    recent_groups,
    scd2_join,
    scd2_snapshot,
    since,
    upsert,
    watermark,
    weighted_median,
)


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, v) for v in row])


def test_by_repos(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "repository_name string")
    assert by_repos(df, ["a", "z"]).count() == 1
    assert by_repos(df, []).count() == 0
    assert by_repos(df, None).count() == 3
    assert by_repos(df, spark.createDataFrame([("b",)], "any string")).count() == 1


def test_by_dates_needs_both_ends(spark):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    assert by_dates(df, "d", date(2024, 1, 2), date(2024, 1, 3)).count() == 2
    assert by_dates(df, "d", date(2024, 1, 2), None).count() == 3


def test_since_leaves_the_partial_first_day_out(spark):
    as_of = datetime(2024, 4, 1, 12)
    days = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 1, 3),)], "d date")
    # The window opens on January 2nd at noon.
    assert tuples(since(days, F.col("d"), as_of, 90)) == [(date(2024, 1, 3),)]
    assert since(days, F.col("d"), datetime(2024, 4, 1), 90).count() == 2
    moments = days.select(F.lit("2024-01-02 12:00:00").cast("timestamp").alias("t"))
    assert since(moments, F.col("t"), as_of, 90).count() == 2


def test_watermark_is_inclusive_and_an_empty_target_loads_all(spark):
    batch = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    target = spark.createDataFrame([(2,), (1,)], "v int")
    empty = target.limit(0)
    assert tuples(after_watermark(batch, F.col("v"), watermark(target, "v"))) == [(2,), (3,)]
    assert after_watermark(batch, F.col("v"), watermark(empty, "v")).count() == 3
    lazily = empty.agg(F.max("v")).scalar()
    assert after_watermark(batch, F.col("v"), lazily).count() == 3
    moments = spark.createDataFrame([(datetime(2024, 3, 31, 2, 30, 0, 123456),)], "t timestamp")
    assert after_watermark(moments, F.col("t"), watermark(moments, "t")).count() == 1


def test_recent_groups(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (3, "y")], "g int, v string")
    assert tuples(recent_groups(df, "g", 2)) == [(2, "x"), (3, "x"), (3, "y")]


VERSIONS = [
    ("k1", "a", date(1900, 1, 1), date(2024, 1, 10)),
    ("k2", "a", date(2024, 1, 10), date(2024, 2, 1)),
    ("k3", "a", date(2024, 2, 1), date(9999, 12, 31)),
    ("k4", "b", date(2024, 1, 5), date(2024, 1, 6)),
]


@pytest.mark.parametrize("salts", [1, 4])
def test_scd2_join_is_half_open_and_keeps_unmatched(spark, salts):
    versions = spark.createDataFrame(
        VERSIONS, "repository_key string, repository_name string, valid_from date, valid_to date"
    )
    rows = [("a", date(2024, 1, 9)), ("a", date(2024, 1, 10)), ("a", date(2024, 2, 1))]
    rows += [("b", date(2024, 1, 6)), ("c", date(2024, 1, 6)), ("a", None), (None, date(2024, 1, 1))]
    facts = spark.createDataFrame(rows, "repo string, day date")
    joined = scd2_join(facts, versions, F.col("repo"), F.col("day"), salts=salts)
    assert joined.columns == ["repo", "day", "repository_key"]
    expected = {("a", date(2024, 1, 9)): "k1", ("a", date(2024, 1, 10)): "k2", ("a", date(2024, 2, 1)): "k3"}
    assert {(r, d): k for r, d, k in map(tuple, joined.collect())} == {
        row: expected.get(row) for row in rows
    }


def test_scd2_join_same_day_versions_match_once(spark):
    versions = spark.createDataFrame(
        [
            ("k1", "a", date(1900, 1, 1), date(2024, 1, 10)),
            ("k2", "a", date(2024, 1, 10), date(2024, 1, 10)),
            ("k3", "a", date(2024, 1, 10), date(9999, 12, 31)),
        ],
        "repository_key string, repository_name string, valid_from date, valid_to date",
    )
    facts = spark.createDataFrame([("a", date(2024, 1, 10))], "repo string, day date")
    assert [row[-1] for row in scd2_join(facts, versions, F.col("repo"), F.col("day")).collect()] == ["k3"]


def test_lookup_join_without_key(spark):
    facts = spark.createDataFrame([(1, "ann"), (2, None), (3, "eve"), (4, None)], "id int, login string")
    # Names that look like the made-up keys of rows without a login must not match them.
    dim = spark.createDataFrame(
        [("ann", "K")] + [(str(i), "no") for i in range(64)], "username string, key string"
    )
    joined = lookup_join(facts, dim, "login", "username", {"key": "author_key"}, "id")
    assert tuples(joined) == [(1, "ann", "K"), (2, None, None), (3, "eve", None), (4, None, None)]


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 5), ("a", 2, "x", 6), ("a", 2, "y", 7), ("b", 1, "z", None)],
        "k string, day int, tie string, v int",
    )
    assert tuples(latest_per_key(df, ["k"], ["day", "tie"], ["v"])) == [("a", 7), ("b", None)]


def test_upsert_keeps_one_row_per_key(spark):
    schema = "id int, v string, at int"
    target = spark.createDataFrame([(1, "old", 1), (2, "old", 1)], schema)
    batch = spark.createDataFrame([(2, "new", 2), (2, "newer", 3), (3, "new", 2)], schema)
    once = upsert(target, batch, ["id"], ["at"])
    assert tuples(once) == [(1, "old", 1), (2, "newer", 3), (3, "new", 2)]
    assert tuples(upsert(once, batch, ["id"], ["at"])) == tuples(once)


def test_delete_insert_keeps_repetitions(spark):
    schema = "id int, v string"
    target = spark.createDataFrame([(1, "old"), (2, "old")], schema)
    batch = spark.createDataFrame([(2, "new"), (2, "new")], schema)
    assert tuples(delete_insert(target, batch, ["id"])) == [(1, "old"), (2, "new"), (2, "new")]


def test_scd2_snapshot(spark):
    day_1, day_2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    schema = "id int, language string, stars int"
    empty = spark.createDataFrame([], schema + ", dbt_valid_from timestamp, dbt_valid_to timestamp")
    first = spark.createDataFrame(
        [(1, "Go", 1), (2, None, 1), (3, "C", 1), (4, "Zig", 1), (5, None, 1)], schema
    )
    history = scd2_snapshot(empty, first, "id", ["language"], day_1)
    second = spark.createDataFrame(
        # changed, still NULL, only stars changed, (4 absent), NULL to value, new
        [(1, "Rust", 2), (2, None, 2), (3, "C", 9), (5, "Ada", 2), (6, "D", 2)],
        schema,
    )
    history = scd2_snapshot(history, second, "id", ["language"], day_2)
    assert tuples(history) == sorted(
        [
            (1, "Go", 1, day_1, day_2),
            (1, "Rust", 2, day_2, None),
            (2, None, 1, day_1, None),
            (3, "C", 1, day_1, None),
            (4, "Zig", 1, day_1, None),
            (5, None, 1, day_1, day_2),
            (5, "Ada", 2, day_2, None),
            (6, "D", 2, day_2, None),
        ],
        key=lambda row: [(v is None, v) for v in row],
    )
    assert tuples(scd2_snapshot(history, second, "id", ["language"], day_2)) == tuples(history)


def test_nested_to_flat(spark):
    schema = "id int, a struct<b: struct<c: int, `d.e`: int>, f: string>, tags array<string>, l array<struct<n: string>>"
    df = spark.createDataFrame([(1, ((2, 3), "x"), ["p", "q"], [("m",)]), (2, None, None, [])], schema)
    flat = flatten_struct(df.select("id", "a"))
    assert flat.columns == ["id", "a__b__c", "a__b__d.e", "a__f"]
    assert tuples(flat) == [(1, 2, 3, "x"), (2, None, None, None)]
    assert tuples(child_rows(df, "tags", ["id"])) == [(1, "p"), (1, "q")]
    children = child_rows(df, "l", ["id"])
    assert children.columns == ["id", "n"] and tuples(children) == [(1, "m")]


def test_expand_runs(spark):
    runs = spark.createDataFrame([("a", 3), ("b", 0), ("c", 10_000)], "k string, n int")
    out = expand_runs(runs, "n", "i", ["k"])
    by_key = {row["k"]: row for row in out.groupBy("k").agg(
        F.count("*").alias("rows"), F.count_distinct("i").alias("distinct"), F.max("i").alias("last")
    ).collect()}
    assert {k: (r["rows"], r["distinct"], r["last"]) for k, r in by_key.items()} == {
        "a": (3, 3, 3),
        "c": (10_000, 10_000, 10_000),
    }


def test_a_long_run_is_spread_over_tasks(spark):
    runs = spark.createDataFrame([("hot", 100_000)], "k string, n int")
    out = expand_runs(runs, "n", "i", ["k"])
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1 and max(row["count"] for row in per_task) < 100_000


def test_weighted_median(spark):
    rng = random.Random(1)
    groups = {g: [rng.randint(0, 20) for _ in range(rng.randint(1, 30))] for g in range(20)}
    rows = [(g, v) for g, values in groups.items() for v in values] + [(0, None), (99, None)]
    runs = spark.createDataFrame(rows, "g int, v int").groupBy("g", "v").agg(F.count("*").alias("n"))
    got = dict(map(tuple, runs.groupBy("g").agg(weighted_median("v", "n")).collect()))
    assert got == {**{g: statistics.median(values) for g, values in groups.items()}, 99: None}
