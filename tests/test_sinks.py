from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from osspulse.sinks import (
    ContractError,
    assert_contract,
    assert_same_schema,
    merge_table,
    row_counts,
    snapshot_table,
    write_table,
)
from osspulse.sources import table_or_empty

SCHEMA = "id int, day int, v string"


@pytest.fixture(autouse=True)
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t")
    yield
    spark.sql("DROP DATABASE t CASCADE")


def rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("id", "day", "v").collect())


def test_contract(spark):
    df = spark.createDataFrame([(1, 2, "x")], SCHEMA)
    assert assert_contract(df.select("v", "id", "day"), df.schema).columns == ["id", "day", "v"]
    with pytest.raises(ContractError, match="day: expected int, got bigint"):
        assert_contract(df.withColumn("day", F.col("day").cast("bigint")), df.schema)
    with pytest.raises(ContractError, match="extra: expected no column"):
        assert_same_schema(df, df.withColumn("extra", F.lit(1)))
    with pytest.raises(ContractError, match="v: expected string, got no column"):
        assert_same_schema(df, df.drop("v"))


def test_write_table_replaces(spark):
    write_table(spark.createDataFrame([(1, 1, "a")], SCHEMA), "t.full")
    write_table(spark.createDataFrame([(2, 2, "b")], SCHEMA), "t.full")
    assert rows(spark, "t.full") == [(2, 2, "b")]
    write_table(spark.table("t.full").withColumn("v", F.lit("c")), "t.full")  # from itself
    assert rows(spark, "t.full") == [(2, 2, "c")]


def test_merge_moves_keys_between_partitions(spark):
    merge = lambda data: merge_table(spark, "t.m", spark.createDataFrame(data, SCHEMA), ["id"], "day")
    assert merge([(1, 1, "a"), (2, 1, "a"), (3, 2, "a"), (4, 3, "a")]) == 4
    # 3 leaves day 2 empty; 1 leaves day 1 with another row in it; 5 is new.
    assert merge([(3, 1, "b"), (1, 4, "b"), (5, 4, "b")]) == 3
    assert rows(spark, "t.m") == [(1, 4, "b"), (2, 1, "a"), (3, 1, "b"), (4, 3, "a"), (5, 4, "b")]
    assert {r[0] for r in spark.sql("SHOW PARTITIONS t.m").collect()} == {"day=1", "day=3", "day=4"}
    assert merge([]) == 0


def test_merge_touches_only_partitions_of_the_batch(spark):
    def files():
        source = spark.table("t.p").select("day", F.input_file_name().alias("f"))
        return {r["day"]: r["f"] for r in source.distinct().collect()}

    data = [(1, 1, "a"), (2, 2, "a"), (3, 3, "a")]
    merge_table(spark, "t.p", spark.createDataFrame(data, SCHEMA), ["id"], "day")
    before = files()
    merge_table(spark, "t.p", spark.createDataFrame([(2, 2, "b")], SCHEMA), ["id"], "day")
    after = files()
    assert {day for day in before if before[day] != after[day]} == {2}


def test_merge_upserts_with_order_and_keeps_repetitions_without(spark):
    batch = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], SCHEMA)
    assert merge_table(spark, "t.u", batch, ["id"], "day", order_by=["v"]) == 1
    assert rows(spark, "t.u") == [(1, 1, "b")]
    assert merge_table(spark, "t.d", batch, ["id"], "day") == 2
    assert merge_table(spark, "t.d", batch, ["id"], "day") == 2
    assert rows(spark, "t.d") == [(1, 1, "a"), (1, 1, "b")]


def test_merge_fails_on_schema_drift(spark):
    batch = spark.createDataFrame([(1, 1, "a")], SCHEMA)
    merge_table(spark, "t.s", batch, ["id"], "day")
    with pytest.raises(ContractError):
        merge_table(spark, "t.s", batch.withColumn("w", F.lit(1)), ["id"], "day")


def test_rows_without_a_partition_value(spark):
    merge = lambda data: merge_table(spark, "t.n", spark.createDataFrame(data, SCHEMA), ["id"], "day")
    merge([(1, None, "a"), (2, 1, "a")])
    for _ in range(3):
        assert merge([(1, None, "b"), (3, None, "b")]) == 2
        found = {(r["id"], r["day"], r["v"]) for r in spark.table("t.n").collect()}
        assert found == {(1, None, "b"), (2, 1, "a"), (3, None, "b")}
    merge([(1, 1, "c"), (3, 2, "c")])
    assert rows(spark, "t.n") == [(1, 1, "c"), (2, 1, "a"), (3, 2, "c")]
    assert {r[0] for r in spark.sql("SHOW PARTITIONS t.n").collect()} == {"day=1", "day=2"}


def test_a_run_that_stops_before_or_between_switches(spark, monkeypatch):
    from osspulse.sinks import tables

    batch = lambda data: spark.createDataFrame(data, SCHEMA)
    merge_table(spark, "t.f", batch([(1, 1, "a"), (2, 1, "a"), (3, 2, "a")]), ["id"], "day")
    later = batch([(1, 2, "b"), (4, 3, "b")])
    whole = tables._switch_partitions

    def stop(*_):
        raise RuntimeError("stopped")

    def half(spark, name, partition_by, folders, gone):
        some = {value: folders[value] for value in sorted(folders)[1:]}
        whole(spark, name, partition_by, some, [])
        raise RuntimeError("stopped")

    for broken in (stop, half):
        monkeypatch.setattr(tables, "_switch_partitions", broken)
        with pytest.raises(RuntimeError, match="stopped"):
            merge_table(spark, "t.f", later, ["id"], "day")
        monkeypatch.setattr(tables, "_switch_partitions", whole)
        assert {(2, 1, "a"), (3, 2, "a")} <= set(rows(spark, "t.f"))  # kept rows are never gone
        if broken is stop:
            assert (1, 1, "a") in rows(spark, "t.f")
    merge_table(spark, "t.f", later, ["id"], "day")
    assert rows(spark, "t.f") == [(1, 2, "b"), (2, 1, "a"), (3, 2, "a"), (4, 3, "b")]

    write_table(batch([(1, 1, "a")]), "t.w")
    monkeypatch.setattr(tables, "_write_files", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        write_table(batch([(2, 2, "b")]), "t.w")
    assert rows(spark, "t.w") == [(1, 1, "a")]


def test_partitioned_rebuild(spark):
    batch = lambda data: spark.createDataFrame(data, SCHEMA)
    write_table(batch([(1, 1, "a"), (2, 2, "a"), (9, None, "a")]), "t.r", partition_by="day")
    write_table(batch([(3, 2, "b"), (4, 3, "b")]), "t.r", partition_by="day")
    assert rows(spark, "t.r") == [(3, 2, "b"), (4, 3, "b")]
    assert {r[0] for r in spark.sql("SHOW PARTITIONS t.r").collect()} == {"day=2", "day=3"}


def test_snapshot_table_over_runs(spark):
    def run(value, at):
        current = spark.createDataFrame([(1, value), (2, "same")], "id int, v string")
        snapshot_table(spark, "t.h", current, "id", ["v"], at)

    run("a", datetime(2024, 1, 1, 1))
    run("b", datetime(2024, 1, 2, 1))
    run("c", datetime(2024, 1, 2, 2))  # twice on one day
    run("c", datetime(2024, 1, 3, 1))
    run("d", datetime(2024, 1, 4, 1))
    history = spark.table("t.h").orderBy("id", "dbt_valid_from").collect()
    assert [(r["id"], r["v"], r["dbt_valid_to"]) for r in history] == [
        (1, "a", datetime(2024, 1, 2, 1)),
        (1, "b", datetime(2024, 1, 2, 2)),
        (1, "c", datetime(2024, 1, 4, 1)),
        (1, "d", None),
        (2, "same", None),
    ]


def test_table_or_empty_and_row_counts(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    empty = table_or_empty(spark, "t.absent", schema)
    assert empty.schema == schema
    counts = row_counts({"none": empty, "two": spark.range(2)})
    assert {r["table"]: r["n"] for r in counts.collect()} == {"none": 0, "two": 2}
    assert row_counts({}).columns == ["table", "n"] and row_counts({}).count() == 0
