"""Table writes: full rebuilds, keyed merges, snapshots.

Tables are Parquet tables of the session catalog. Every write puts its files in a folder of its own and
then switches the table, or the partitions it touches, to that folder; folders that nothing points to
any more are deleted last. A run that stops before the switch has changed nothing, one that stops
between the switches of two partitions leaves whole partitions, old or new, and repeating the batch
completes it. Nothing is renamed, so object stores suit. A merge rewrites only the partitions that hold
keys of the batch: the cost of a run follows the batch, not the table.

Tables that must fit together are switched by a `WriteGroup`: all its files are written first, then a journal says which
switches follow, and `finish_switches` completes what a journal says after a stop in between.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime
from typing import Protocol
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.functions import utc_naive
from osspulse.operators.deltas import signed
from osspulse.operators.history import OPEN_END, scd2_snapshot
from osspulse.operators.merge import latest_in_batch
from osspulse.sinks.contracts import assert_contract, assert_same_schema
from osspulse.sinks.staging_area import cut_lineage
from osspulse.sources.tables import fresh_table

# Fixed value: how a folder names the partition of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Partitions added or dropped by one statement.
PER_STATEMENT = 200
# Storage partition of a change log, and the number of buckets of a key index.
BATCH, INDEX_BUCKETS = "_batch", 64


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        fs, target = _filesystem(spark, path)
        fs.delete(target, True)


def _new_folder(spark: SparkSession, name: str) -> str:
    database, _, table = name.rpartition(".")
    root = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{table}/{uuid.uuid4().hex}"


class Guard(Protocol):
    """Watches what is written, and afterwards raises if it must not become visible."""

    def watch(self, df: DataFrame) -> DataFrame: ...

    def verify(self) -> None: ...


def _watched(df: DataFrame, partition_by: str | None, guard: Guard | None) -> DataFrame:
    # Rebalanced by partition value: large values are split over several files, small ones do
    # not leave a file per task.
    out = df.hint("rebalance", partition_by) if partition_by else df
    return guard.watch(out) if guard is not None else out


def _write_files(df: DataFrame, path: str, partition_by: str | None, guard: Guard | None = None) -> None:
    writer = _watched(df, partition_by, guard).write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def _written_partitions(spark: SparkSession, path: str, partition_by: str) -> dict[str, str]:
    """Folder of each partition value below `path`, by the value as its folder names it."""
    fs, target = _filesystem(spark, path)
    start = f"{partition_by}="
    names = (status.getPath().getName() for status in fs.listStatus(target))
    return {unquote(name.removeprefix(start)): f"{path}/{name}" for name in names if name.startswith(start)}


def _known_partitions(spark: SparkSession, name: str, partition_by: str) -> set[str]:
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {unquote(row[0].removeprefix(f"{partition_by}=")) for row in rows}


def _spec(partition_by: str, value: str) -> str:
    literal = "null" if value == NO_VALUE else "'" + value.replace("'", "\\'") + "'"
    return f"PARTITION ({partition_by} = {literal})"


def _location(spark: SparkSession, name: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition}").collect()
    return next(row[1] for row in rows if row[0] == "Location")


def _tail(path: str) -> list[str]:
    """The new folder and the partition of a location, however its root is written."""
    return unquote(path).rstrip("/").split("/")[-2:]


def _switch_partitions(
    spark: SparkSession, name: str, partition_by: str, folders: dict[str, str], gone: Iterable[str]
) -> None:
    """Point partitions to their new folders, drop the `gone` ones, then delete what they pointed to."""
    known = _known_partitions(spark, name, partition_by)
    gone = sorted(set(gone) & known)
    again = sorted(set(folders) & known)
    left = [_location(spark, name, _spec(partition_by, value)) for value in [*again, *gone]]
    # Switched already, if this completes an earlier try.
    left = [path for path in left if _tail(path) not in map(_tail, folders.values())]
    new = sorted(set(folders) - known)
    for at in range(0, len(new), PER_STATEMENT):
        added = " ".join(
            f"{_spec(partition_by, value)} LOCATION '{folders[value]}'" for value in new[at : at + PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for value in again:
        spark.sql(f"ALTER TABLE {name} {_spec(partition_by, value)} SET LOCATION '{folders[value]}'")
    for at in range(0, len(gone), PER_STATEMENT):
        dropped = ", ".join(_spec(partition_by, value) for value in gone[at : at + PER_STATEMENT])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {dropped}")
    spark.catalog.refreshTable(name)
    _delete(spark, left)


def _switch_table(spark: SparkSession, name: str, path: str) -> None:
    before = _location(spark, name)
    if _tail(before) == _tail(path):
        return
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    _delete(spark, [before])


class WriteGroup:
    """New contents of several tables that appear together.

    A stop before the journal is complete leaves all tables as they were; after one later than that
    `finish_switches` brings all of them to their new contents.
    """

    def __init__(self, spark: SparkSession, database: str):
        # One journal at a time: what an earlier group left is completed first.
        finish_switches(spark, database)
        self.spark, self.journal = spark, _journal(spark, database)
        self.switches: list[dict] = []

    def replace_partitions(self, df: DataFrame, name: str, partition_by: str, touched: Iterable) -> DataFrame:
        """`df` in place of the `touched` partitions, at the commit; returns it as it was written."""
        spark, path = self.spark, _new_folder(self.spark, name)
        columns = spark.table(name).columns
        _write_files(df.select(*columns), path, partition_by)
        folders = _written_partitions(spark, path, partition_by)
        gone = sorted({_text(value) for value in touched} - set(folders))
        self.switches.append({"name": name, "partition_by": partition_by, "folders": folders, "gone": gone})
        return spark.read.schema(spark.table(name).schema).parquet(path)

    def replace_table(self, df: DataFrame, name: str) -> DataFrame:
        """`df` in place of an unpartitioned table, at the commit."""
        path = _new_folder(self.spark, name)
        _write_files(df.select(*self.spark.table(name).columns), path, None)
        self.switches.append({"name": name, "path": path})
        return self.spark.read.schema(self.spark.table(name).schema).parquet(path)

    def drop_partitions(self, name: str, partition_by: str, values: Iterable) -> None:
        self.switches.append({"name": name, "partition_by": partition_by, "folders": {}, "gone": sorted(map(_text, values))})

    def commit(self) -> None:
        if self.switches:
            lines = self.spark.createDataFrame([(json.dumps(x),) for x in self.switches], "line string").coalesce(1)
            lines.write.mode("overwrite").text(self.journal)
            _finish(self.spark, self.journal, self.switches)


def _journal(spark: SparkSession, database: str) -> str:
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_switches"


def _finish(spark: SparkSession, journal: str, switches: Iterable[dict]) -> None:
    for x in switches:
        if "path" in x:
            _switch_table(spark, x["name"], x["path"])
        else:
            _switch_partitions(spark, x["name"], x["partition_by"], x["folders"], x["gone"])
    _delete(spark, [journal])


def finish_switches(spark: SparkSession, database: str) -> bool:
    """Complete the switches of a group that stopped after its journal was written; whether there was one."""
    journal = _journal(spark, database)
    fs, done = _filesystem(spark, f"{journal}/_SUCCESS")
    if not fs.exists(done):
        return False
    _finish(spark, journal, [json.loads(row[0]) for row in spark.read.text(journal).collect()])
    return True


def _create(df: DataFrame, name: str, partition_by: str | None, guard: Guard | None = None) -> None:
    writer = _watched(df, partition_by, guard).write.format("parquet").option("path", _new_folder(df.sparkSession, name))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.mode("overwrite").saveAsTable(name)


def write_table(
    df: DataFrame,
    name: str,
    schema: T.StructType | None = None,
    partition_by: str | None = None,
    guard: Guard | None = None,
) -> None:
    """Full rebuild beside the old rows, to which the table is switched once it is complete.

    Readers find the table at any time. A partitioned table is switched partition by partition. Rows that
    the `guard` refuses are deleted again, and the table stays as it was, or absent.
    """
    spark = df.sparkSession
    if schema is not None:
        df = assert_contract(df, schema)
    exists = spark.catalog.tableExists(name)
    if not exists and guard is None:
        _create(df, name, partition_by)
        return
    if not exists or not _same_layout(df, name, partition_by):
        # Another layout is another table.
        fresh = f"{name}__next"
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        _create(df, fresh, partition_by, guard)
        if guard is not None:
            try:
                guard.verify()
            except Exception:
                where = _location(spark, fresh)
                spark.sql(f"DROP TABLE {fresh}")
                _delete(spark, [where])
                raise
        if exists:
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        return
    path = _new_folder(spark, name)
    rest = [c for c in df.columns if c != partition_by]
    _write_files(df.select(*rest, *([partition_by] if partition_by else [])), path, partition_by, guard)
    if guard is not None:
        try:
            guard.verify()
        except Exception:
            _delete(spark, [path])
            raise
    if partition_by:
        folders = _written_partitions(spark, path, partition_by)
        known = _known_partitions(spark, name, partition_by)
        _switch_partitions(spark, name, partition_by, folders, known - set(folders))
        return
    _switch_table(spark, name, path)


def _same_layout(df: DataFrame, name: str, partition_by: str | None) -> bool:
    spark = df.sparkSession
    same = {(f.name, f.dataType) for f in spark.table(name).schema} == {(f.name, f.dataType) for f in df.schema}
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return same and parts == ([partition_by] if partition_by else [])


def _text(value) -> str:
    return NO_VALUE if value is None else str(value)


def _replace_partitions(df: DataFrame, name: str, partition_by: str, touched: Iterable) -> None:
    """`df` in place of the `touched` partitions; those of them without rows in it are dropped."""
    spark = df.sparkSession
    path = _new_folder(spark, name)
    _write_files(df.select(*spark.table(name).columns), path, partition_by)
    folders = _written_partitions(spark, path, partition_by)
    gone = {_text(value) for value in touched} - set(folders)
    _switch_partitions(spark, name, partition_by, folders, gone)


def merge_table(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: str,
    *,
    order_by: Sequence[str] = (),
    transient: Sequence[str] = (),
    schema: T.StructType | None = None,
    key_fixes_partition: bool = False,
    indexed: bool = False,
    change_log: str | None = None,
) -> int:
    """Replace the table's rows that have a key of the batch by the batch; returns the batch's rows.

    With `order_by` the batch is first reduced to its newest row per key (an upsert); without, its
    repetitions are kept (delete and insert). `transient` columns serve that order and are not stored.
    The first batch creates the table; a later one with other columns fails. Rows without a value of
    `partition_by` have a partition of their own.

    A key may move to another partition, so its old one is looked up: in the key index of the table if it is
    `indexed`, else in its key columns. `key_fixes_partition` says that the key implies the partition,
    which saves that look. `change_log`: a table that gets the replaced rows and the batch as signed
    rows, in a partition of their own (`_batch`). Table, index and log change together.
    """
    if schema is not None:
        batch = assert_contract(batch, schema)
    if order_by:
        batch = latest_in_batch(batch, keys, order_by)
    batch = batch.drop(*transient)
    if not spark.catalog.tableExists(name):
        if change_log is None and not indexed:
            _create(batch, name, partition_by)
            return spark.table(name).count()
        _create(batch.limit(0), name, partition_by)

    group = WriteGroup(spark, name.rpartition(".")[0] or spark.catalog.currentDatabase())
    target = fresh_table(spark, name)
    batch = cut_lineage(assert_same_schema(target, batch))
    per_value = batch.groupBy(partition_by).agg(F.count("*").alias("n")).collect()
    rows = sum(row["n"] for row in per_value)
    touched = {row[0] for row in per_value}
    batch_keys = batch.select(*keys).distinct()
    if indexed:
        index = KeyIndex(spark, name, keys, partition_by)
        touched |= index.places(batch_keys)
        index.stage(group, batch)
    elif not key_fixes_partition:
        places = target.select(*dict.fromkeys([*keys, partition_by]))
        known = places.join(batch_keys, list(keys), "left_semi")
        touched |= {row[0] for row in known.select(partition_by).distinct().collect()}
    if not touched:
        return 0
    inside = fresh_table(spark, name).filter(in_partitions(partition_by, touched))
    kept = inside.join(batch_keys, list(keys), "left_anti")
    group.replace_partitions(kept.unionByName(batch), name, partition_by, touched)
    if change_log is not None:
        replaced = inside.join(batch_keys, list(keys), "left_semi").select(*batch.columns)
        number = uuid.uuid4().hex
        changes = signed(replaced, batch).withColumn(BATCH, F.lit(number))
        if not spark.catalog.tableExists(change_log):
            _create(changes.limit(0), change_log, BATCH)
        group.replace_partitions(changes, change_log, BATCH, [number])
    group.commit()
    return rows


def in_partitions(partition_by: str, values: Iterable) -> Column:
    """Rows of these partitions. A list of partition values, not of rows."""
    values = set(values)
    chosen = F.col(partition_by).isin([value for value in values if value is not None])
    return chosen | F.col(partition_by).isNull() if None in values else chosen


class KeyIndex:
    """Where a table's keys are: hashes of keys and their partition, in buckets of the hash.

    A look-up reads the buckets of the wanted keys, and a merge rewrites those in which a key is new or
    has moved. A table that has rows but no index gets one from its key columns, once.
    """

    def __init__(self, spark: SparkSession, table: str, keys: Sequence[str], partition_by: str):
        self.spark, self.table, self.keys, self.partition_by = spark, table, list(keys), partition_by
        self.name = f"{table}__keys"
        self.kind = spark.table(table).schema[partition_by].dataType
        if not spark.catalog.tableExists(self.name):
            _create(self.entries(fresh_table(spark, table)), self.name, "_bucket")

    def entries(self, rows: DataFrame) -> DataFrame:
        known = rows.select(
            F.xxhash64(*self.keys).alias("_k1"),
            F.hash(*self.keys).alias("_k2"),
            F.coalesce(F.col(self.partition_by).cast("string"), F.lit(NO_VALUE)).alias("_place"),
        )
        return known.distinct().withColumn("_bucket", self.bucket())

    @staticmethod
    def bucket() -> Column:
        return F.pmod("_k1", F.lit(INDEX_BUCKETS)).cast("int")

    def read(self, keys: DataFrame) -> DataFrame:
        """The index's rows in the buckets of these keys (columns `_k1`, `_k2`)."""
        buckets = [row[0] for row in keys.select(self.bucket()).distinct().collect()]
        return fresh_table(self.spark, self.name).filter(F.col("_bucket").isin(buckets))

    def hashed(self, keys: DataFrame) -> DataFrame:
        return keys.select(F.xxhash64(*self.keys).alias("_k1"), F.hash(*self.keys).alias("_k2"))

    def places(self, keys: DataFrame) -> set:
        """The partitions that hold any of these keys."""
        wanted = self.hashed(keys)
        found = self.read(wanted).join(wanted, ["_k1", "_k2"], "left_semi").select("_place").distinct()
        value = F.when(F.col("_place") != NO_VALUE, F.col("_place").try_cast(self.kind))
        return {row[0] for row in found.select(value).collect()}

    def stage(self, group: WriteGroup, batch: DataFrame) -> None:
        """The batch's keys at their new places, in the buckets where that changes anything."""
        entries = cut_lineage(self.entries(batch))
        there = self.read(entries)
        moved = entries.join(there.select("_k1", "_k2", "_place"), ["_k1", "_k2", "_place"], "left_anti")
        buckets = [row[0] for row in moved.select("_bucket").distinct().collect()]
        if not buckets:
            return
        chosen = F.col("_bucket").isin(buckets)
        kept = there.filter(chosen).join(entries, ["_k1", "_k2"], "left_anti")
        group.replace_partitions(kept.unionByName(entries.filter(chosen)), self.name, "_bucket", buckets)


def snapshot_table(
    spark: SparkSession,
    name: str,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime,
) -> None:
    """Bring the type 2 history in `name` up to `current` at `run_ts`.

    The table is partitioned by the day a row was closed (`closed_on`, `9999-12-31` = open). A run
    reads and rewrites the open rows and those closed on its own day; older days are final.
    """
    history_columns = [*current.columns, "dbt_valid_from", "dbt_valid_to"]
    closed_on = F.coalesce(F.date_format("dbt_valid_to", "yyyy-MM-dd"), F.lit(OPEN_END))
    if not spark.catalog.tableExists(name):
        nothing = T.StructType(
            [
                *current.schema.fields,
                T.StructField("dbt_valid_from", T.TimestampType()),
                T.StructField("dbt_valid_to", T.TimestampType()),
            ]
        )
        first = scd2_snapshot(spark.createDataFrame([], nothing), current, key, check_cols, run_ts)
        _create(first.withColumn("closed_on", closed_on), name, "closed_on")
        return
    table = fresh_table(spark, name)
    assert_same_schema(table.select(*current.columns), current)
    today = utc_naive(run_ts).date().isoformat()
    live = table.filter(F.col("closed_on").isin(OPEN_END, today)).select(*history_columns)
    after = scd2_snapshot(live, current, key, check_cols, run_ts)
    _replace_partitions(after.withColumn("closed_on", closed_on), name, "closed_on", [OPEN_END, today])


def row_counts(tables: dict[str, DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """`table, n` for every given frame; no rows for none."""
    result = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        result = one if result is None else result.unionByName(one)
    if result is None:
        session = spark or SparkSession.active()
        return session.createDataFrame([], "table string, n bigint")
    return result
