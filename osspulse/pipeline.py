"""The daily run: landed records and the download log to raw tables, history, dimensions, facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse import schemas, upkeep
from osspulse.functions import date_key, utc_naive
from osspulse.operators.filters import after_watermark, watermark
from osspulse.plans import activity, dims, facts, staging
from osspulse.quality.guards import ChecksFailed
from osspulse.quality.suites import mart_suites, run_suites, staging_suites
from osspulse.sinks import (
    Layer,
    assert_contract,
    catalog_marts,
    ensure_layers,
    finish_switches,
    merge_table,
    snapshot_table,
    write_table,
)
from osspulse.sources import (
    PAGE,
    daily_downloads,
    fresh_table,
    read_endpoint,
    read_projects,
    stamp,
    table_or_empty,
    target_packages,
    target_repos,
)

# Storage partition of a raw table: the month of a moment that belongs to the record.
RAW_PARTITION = "_month"
UNDATED = "0000-00"
# Copies of a dimension for its join with the facts, so that no key is one task's alone.
SALTS = 4
# Storage partition of the facts that are merged by key.
FACT_PARTITION = "date_key"
# The day up to which landed records were loaded, by endpoint; the results of the checks.
LOAD_STATE = Layer.RAW.table("load_state")
CHECK_RESULTS = Layer.INTERMEDIATE.table("check_results")


@dataclass(frozen=True)
class RawTable:
    """How one endpoint is merged into its raw table.

    `cursor`: newest value loaded so far bounds the next load. `version` tells which of several
    records with one key is the newest. `month_of` picks the storage partition;
    `key_fixes_partition` if a record's key implies it (a commit hash covers its date).
    """

    keys: Sequence[str]
    month_of: str
    cursor: str | None = None
    key_fixes_partition: bool = False
    version: str = "_loaded_at"


RAW_TABLES: dict[str, RawTable] = {
    "repositories": RawTable(["id"], "created_at", version="updated_at"),
    "commits": RawTable(["sha"], "commit.author.date", "commit.author.date", True),
    "issues": RawTable(["_repo", "number"], "created_at", "updated_at", version="updated_at"),
    "pull_requests": RawTable(["_repo", "number"], "created_at", "updated_at", version="updated_at"),
    "releases": RawTable(["id"], "published_at"),
}
DOWNLOADS = RawTable(["_package", "date"], "date", None, True)


def with_month(df: DataFrame, table: RawTable) -> DataFrame:
    month = F.date_format(F.col(table.month_of).cast("timestamp"), "yyyy-MM")
    return df.withColumn(RAW_PARTITION, F.coalesce(month, F.lit(UNDATED)))


def after_cursor(
    batch: DataFrame, raw: DataFrame, cursor: str, per: Sequence[str] = ()
) -> DataFrame:
    """Batch rows at or after the newest cursor value in `raw`.

    The cursor spans all repositories, so a repository tracked later starts at it too; `per`
    (e.g. `["_repo"]`) keeps one cursor per group instead, and loads a new group in full.
    """
    if not per:
        return after_watermark(batch, F.col(cursor), watermark(raw.select(F.col(cursor).alias("c")), "c"))
    marks = raw.groupBy(*per).agg(F.max(cursor).alias("_mark"))
    bounded = batch.join(marks, list(per), "left")
    return after_watermark(bounded, F.col(cursor), F.col("_mark")).select(*batch.columns)


def partition_watermark(spark: SparkSession, table: str, column: str) -> Column | None:
    """Highest value of the partition column, from the catalog's list of partitions: no scan."""
    kind = spark.table(table).schema[column].dataType.simpleString()
    # The partition of rows without a value does not cast, and is no mark.
    value = F.regexp_extract("partition", f"{column}=([^/]*)", 1).try_cast(kind)
    values = spark.sql(f"SHOW PARTITIONS {table}").select(value.alias(column))
    return watermark(values, column)


def load_raw(
    spark: SparkSession, endpoint: str, batch: DataFrame, cursor_by: Sequence[str] = ()
) -> int:
    """Upsert landed records of one endpoint into its raw table; returns the rows loaded."""
    table, name = RAW_TABLES[endpoint], Layer.RAW.table(endpoint)
    if table.cursor is not None and spark.catalog.tableExists(name):
        raw = spark.table(name)
        if table.cursor == table.month_of and not cursor_by:
            # The newest value is in the newest month; without any month nothing has a value.
            newest = partition_watermark(spark, name, RAW_PARTITION)
            raw = raw.filter(F.col(RAW_PARTITION) == (F.lit(UNDATED) if newest is None else newest))
        batch = after_cursor(batch, raw, table.cursor, cursor_by)
    return merge_table(
        spark,
        name,
        with_month(batch, table),
        table.keys,
        RAW_PARTITION,
        order_by=[table.version, "_loaded_at", PAGE],
        transient=[PAGE],
        key_fixes_partition=table.key_fixes_partition,
        indexed=not table.key_fixes_partition and endpoint in upkeep.LOGGED,
        change_log=upkeep.change_log(endpoint) if endpoint in upkeep.LOGGED else None,
    )


def load_downloads(spark: SparkSession, counted: DataFrame) -> int:
    """Upsert counted days; a day counted again replaces its rows."""
    return merge_table(
        spark,
        Layer.RAW.table("downloads"),
        with_month(counted, DOWNLOADS),
        DOWNLOADS.keys,
        RAW_PARTITION,
        order_by=[DOWNLOADS.version],
        key_fixes_partition=DOWNLOADS.key_fixes_partition,
    )


def is_backfill(now: datetime, interval_end: datetime) -> bool:
    """An interval that ended more than a day ago: its landed records are left alone."""
    return (utc_naive(now) - utc_naive(interval_end)).days > 1


def raw_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Raw tables by name, typed and empty where nothing was loaded yet."""
    return {
        name: table_or_empty(spark, Layer.RAW.table(name), schema) for name, schema in schemas.RAW.items()
    }


def staged(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging frames by name."""
    return {
        "stg_repositories": staging.stg_repositories(raw["repositories"]),
        "stg_commits": staging.stg_commits(raw["commits"]),
        "stg_issues": staging.stg_issues(raw["issues"]),
        "stg_issue_labels": staging.stg_issue_labels(raw["issues"]),
        "stg_pull_requests": staging.stg_pull_requests(raw["pull_requests"]),
        "stg_pr_labels": staging.stg_pr_labels(raw["pull_requests"]),
        "stg_releases": staging.stg_releases(raw["releases"]),
        "stg_downloads": staging.stg_downloads(raw["downloads"]),
    }


def register_views(spark: SparkSession) -> list[str]:
    """Staging and the activity events as temporary views, for SQL over them; returns their names."""
    views = staged(raw_tables(spark))
    views["contributor_activity"] = activity.contributor_activity(
        views["stg_commits"], views["stg_pull_requests"], views["stg_issues"]
    )
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def _merge_fact(
    spark: SparkSession,
    name: str,
    rows: DataFrame,
    moment: Column,
    mark: str,
    build: Callable[[DataFrame], DataFrame],
    key: str,
    *,
    key_fixes_partition: bool = False,
    backfill: bool = False,
) -> None:
    """Delete and insert the fact rows of what arrived since the table's own watermark.

    The watermark is read first and given to the scan as a literal, so the incremental filter runs
    before the joins. An empty table has none, and everything is loaded.
    """
    table = Layer.MARTS.table(name)
    if spark.catalog.tableExists(table) and not backfill:
        if mark == FACT_PARTITION:
            newest = partition_watermark(spark, table, mark)
        else:
            newest = watermark(spark.table(table), mark)
        rows = after_watermark(rows, moment, newest)
    merge_table(
        spark,
        table,
        build(rows),
        [key],
        FACT_PARTITION,
        schema=schemas.MARTS[name],
        key_fixes_partition=key_fixes_partition,
    )


def build_marts(
    spark: SparkSession,
    projects: DataFrame,
    run_ts: datetime,
    backfill: bool = False,
    full_refresh: bool = False,
) -> None:
    """Snapshot, dimensions and facts from the raw tables.

    What follows from commits, issues and pull requests is kept up from their logged changes (`osspulse.upkeep`), and made
    from all raw rows the first time. `backfill` lifts the day watermark of downloads and metrics, which otherwise leaves out days
    older than the newest one loaded. `full_refresh` rebuilds everything from all raw rows.
    """
    raw = raw_tables(spark)
    s = staged(raw)

    def rebuild(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        table = Layer.MARTS.table(name)
        write_table(df, table, schemas.MARTS[name], partition_by)
        return spark.table(table)

    def merge(name: str, rows: DataFrame, moment: Column, mark: str, build, key: str, **options) -> None:
        if full_refresh:
            rebuild(name, build(rows), FACT_PARTITION)
        else:
            _merge_fact(spark, name, rows, moment, mark, build, key, **options)

    snapshot_table(
        spark,
        Layer.SNAPSHOTS.table("snap_repositories"),
        s["stg_repositories"],
        "repository_id",
        dims.VERSIONED_ATTRIBUTES,
        run_ts,
    )
    history = spark.table(Layer.SNAPSHOTS.table("snap_repositories"))
    if not spark.catalog.tableExists(Layer.MARTS.table("dim_dates")) or full_refresh:
        rebuild("dim_dates", dims.dim_dates(spark))
    versions = dims.dim_repositories(history)
    if full_refresh or not upkeep.can_keep_up(spark):
        rebuild("dim_repositories", versions)
        upkeep.rebuild_all(spark, raw, s, spark.table(Layer.MARTS.table("dim_repositories")), SALTS)
    else:
        upkeep.Upkeep(spark, raw, assert_contract(versions, schemas.MARTS["dim_repositories"]), SALTS).run()
    repositories, people = (fresh_table(spark, Layer.MARTS.table(name)) for name in ("dim_repositories", "dim_contributors"))

    # By load time: author and publishing dates do not only grow.
    loaded = F.col("_loaded_at")
    merge(
        "fct_commits",
        s["stg_commits"],
        loaded,
        "_loaded_at",
        lambda rows: facts.fct_commits(rows, repositories, people, SALTS),
        "commit_key",
        key_fixes_partition=True,
    )
    merge(
        "fct_releases",
        s["stg_releases"],
        loaded,
        "_loaded_at",
        lambda rows: facts.fct_releases(rows, repositories, SALTS),
        "release_key",
    )
    # By day.
    merge(
        "fct_daily_downloads",
        s["stg_downloads"],
        date_key(F.col("download_date")),
        "date_key",
        lambda rows: facts.fct_daily_downloads(rows, projects, repositories, SALTS),
        "download_key",
        key_fixes_partition=True,
        backfill=backfill,
    )
    merge(
        "fct_repository_metrics",
        s["stg_repositories"],
        date_key(loaded),
        "date_key",
        lambda rows: facts.fct_repository_metrics(rows, repositories, SALTS),
        "metric_key",
        key_fixes_partition=True,
        backfill=backfill,
    )


def load_state(spark: SparkSession) -> dict[str, date]:
    """Day up to which each endpoint was loaded; one row per endpoint."""
    schema = schemas.record(endpoint=schemas.STRING, load_day=schemas.DATE)
    return {row.endpoint: row.load_day for row in table_or_empty(spark, LOAD_STATE, schema).collect()}


def _save_load_state(spark: SparkSession, state: dict[str, date]) -> None:
    rows = spark.createDataFrame(sorted(state.items()), "endpoint string, load_day date")
    write_table(rows.coalesce(1), LOAD_STATE)


def check_layer(spark: SparkSession, layer: str, tables, suites, run_ts: datetime, enforce: bool) -> None:
    """Run the suites, keep their result in `CHECK_RESULTS`, and fail on violations of severity `error`."""
    found = run_suites(tables, suites).select(
        F.lit(layer).alias("layer"), F.lit(utc_naive(run_ts).isoformat(sep=" ")).alias("run_at"), "*"
    )
    merge_table(spark, CHECK_RESULTS, found, ["layer", "run_at", "table", "check"], "run_at")
    run_at = utc_naive(run_ts).isoformat(sep=" ")
    results = fresh_table(spark, CHECK_RESULTS).filter((F.col("run_at") == run_at) & (F.col("layer") == layer))
    failed = results.filter("status = 'error'").select("table", "check", "violations").collect()
    if failed and enforce:
        raise ChecksFailed("; ".join(f"{row.table}: {row.check}: {row.violations}" for row in failed))


def child_counts(spark: SparkSession) -> dict[str, int]:
    """Rows of the lists in the raw tables: topics, parents and labels."""
    raw = raw_tables(spark)
    lists = {
        "repositories__topics": ("repositories", "topics"),
        "commits__parents": ("commits", "parents"),
        "issues__labels": ("issues", "labels"),
        "pull_requests__labels": ("pull_requests", "labels"),
    }
    sizes = {
        name: raw[table].agg(F.coalesce(F.sum(F.greatest(F.size(column), F.lit(0))), F.lit(0))).first()[0]
        for name, (table, column) in lists.items()
    }
    return sizes


def run_day(
    spark: SparkSession,
    landing: str,
    projects_path: str,
    now: datetime,
    download_log: DataFrame | None = None,
    *,
    target_date: date | None = None,
    interval_end: datetime | None = None,
    cursor_by: Sequence[str] = (),
    backfill: bool = False,
    full_refresh: bool = False,
    landed_since: date | None = None,
    multi_line: bool = False,
    enforce: bool = True,
) -> DataFrame:
    """One daily run; returns `table, n`: rows loaded per raw table, and rows of the raw tables' lists.

    `now` is the run time of the snapshot. Landing days are read from the last one loaded, or from
    `landed_since`, up to the day of `now`; with a cursor per group (`cursor_by`) all of
    them are. `full_refresh` rebuilds the incremental facts. Downloads are counted for `target_date`, by default the day before. Landed
    records are skipped when `interval_end` shows that an old interval is being repeated, and when no
    repository is tracked. The checks of a layer run when it is complete; with `enforce` a violation of
    severity `error` stops the run there.
    """
    ensure_layers(spark)
    for layer in Layer:
        finish_switches(spark, layer.value)
    write_table(read_projects(spark, projects_path), Layer.STAGING.table("projects"), schemas.PROJECTS)
    projects = spark.table(Layer.STAGING.table("projects"))

    loaded: dict[str, int] = {}
    tracked = target_repos(projects)
    if not (interval_end and is_backfill(now, interval_end)) and not tracked.isEmpty():
        state, today = load_state(spark), utc_naive(now).date()
        for endpoint in RAW_TABLES:
            first_day = landed_since or (None if cursor_by else state.get(endpoint))
            landed = read_endpoint(spark, landing, endpoint, first_day, today, tracked, multi_line)
            loaded[endpoint] = load_raw(spark, endpoint, landed, cursor_by)
            state[endpoint] = max(today, state.get(endpoint, today))
        _save_load_state(spark, state)
    if download_log is not None:
        packages = target_packages(projects)
        day = target_date or (utc_naive(now).date() - timedelta(days=1))
        if not packages.isEmpty():
            counted = stamp(daily_downloads(download_log, day, packages), now)
            loaded["downloads"] = load_downloads(spark, counted)

    checked = {**staged(raw_tables(spark)), "projects": projects}
    check_layer(spark, "staging", checked, staging_suites(), now, enforce)
    build_marts(spark, projects, now, backfill, full_refresh)
    marts = catalog_marts(spark)
    check_layer(spark, "marts", marts, mart_suites(marts), now, enforce)
    return spark.createDataFrame([*loaded.items(), *child_counts(spark).items()], "table string, n bigint")

