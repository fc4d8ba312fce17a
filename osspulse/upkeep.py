"""Marts kept up from the changes of the raw tables instead of being rebuilt.

Merges of commits, issues and pull requests log the rows they replace and the new ones as signed rows (`raw.*__changes`).
Facts with one row per record lose the logged keys and get the new rows, in the partitions of both. What counts
persons and labels follows from counts per finest key (`intermediate.login_events`, `intermediate.label_counts`), to
which the signs are added: a person's dimension row and months are made anew from their counts, in the buckets of the persons
that the changes touch. Records whose repository version changed get their key again, from the day of the change on.
All of it, and the end of the logged batches, is switched as one group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse import schemas
from osspulse.functions import date_key, surrogate_key
from osspulse.operators.deltas import SIGN, add_counts, count_changes, net, replace_keys, split, through
from osspulse.plans import activity, dims, facts, staging
from osspulse.sinks import Layer, WriteGroup, cut_lineage, in_partitions, write_table
from osspulse.sinks.tables import BATCH
from osspulse.sources import fresh_table

# Storage partitions: of tables by person, and of what belongs to an issue (the raw table's own).
BUCKET, PERSON_BUCKETS = "_bucket", 64
MONTH = "_month"
EVENTS, LABEL_COUNTS = Layer.INTERMEDIATE.table("login_events"), Layer.INTERMEDIATE.table("label_counts")
EVENT_KEYS = ["username", "activity_type", "repository", "event_date"]
LABEL_KEYS = ["label_name", "label_color"]
LOGGED = ("commits", "issues", "pull_requests")
OPENED_PARTITION = "opened_date_key"


def change_log(endpoint: str) -> str:
    return Layer.RAW.table(f"{endpoint}__changes")


def person_bucket() -> Column:
    return F.pmod(F.xxhash64("username"), F.lit(PERSON_BUCKETS)).cast("int")


def with_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn(BUCKET, person_bucket())


def _placed(df: DataFrame, mart: str, *storage: str) -> DataFrame:
    """`df` in the order of the mart's contract, and its storage columns."""
    return df.select(*schemas.MARTS[mart].fieldNames(), *storage)


def pending_batches(spark: SparkSession) -> dict[str, list[str]]:
    """Logged batches that the marts have not seen, by endpoint."""
    found = {}
    for endpoint in LOGGED:
        log = change_log(endpoint)
        rows = spark.sql(f"SHOW PARTITIONS {log}").collect() if spark.catalog.tableExists(log) else []
        found[endpoint] = [row[0].removeprefix(f"{BATCH}=") for row in rows]
    return found


def can_keep_up(spark: SparkSession) -> bool:
    """Whether the marts and their counts exist in the layout that changes apply to."""
    placed = {
        Layer.MARTS.table("dim_contributors"): BUCKET,
        Layer.MARTS.table("fct_contributor_activity_monthly"): BUCKET,
        Layer.MARTS.table("bridge_issue_labels"): MONTH,
        Layer.MARTS.table("fct_pull_requests"): OPENED_PARTITION,
        Layer.MARTS.table("fct_issues"): OPENED_PARTITION,
        EVENTS: BUCKET,
    }
    whole = (Layer.MARTS.table("dim_labels"), Layer.MARTS.table("dim_repositories"), LABEL_COUNTS)
    return all(spark.catalog.tableExists(name) for name in (*placed, *whole)) and all(
        partition in spark.table(name).columns for name, partition in placed.items()
    )


def rebuild_all(
    spark: SparkSession, raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame], repositories: DataFrame, salts: int
) -> None:
    """The counts and the marts made of them, from all raw rows; logged batches are done with."""
    batches = pending_batches(spark)
    events = activity.login_events(staged["stg_commits"], staged["stg_pull_requests"], staged["stg_issues"])
    counted = events.groupBy(*EVENT_KEYS).agg(F.count(F.lit(1)).alias("n"))
    write_table(with_bucket(counted), EVENTS, partition_by=BUCKET)
    labels = staged["stg_issue_labels"].select(*LABEL_KEYS).unionByName(staged["stg_pr_labels"].select(*LABEL_KEYS))
    write_table(labels.groupBy(*LABEL_KEYS).agg(F.count(F.lit(1)).alias("n")), LABEL_COUNTS)
    counted = fresh_table(spark, EVENTS)

    def rebuild(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        storage = [partition_by] if partition_by and partition_by not in schemas.MARTS[name].fieldNames() else []
        contract = schemas.MARTS[name]
        assert_types(df, name)
        write_table(_placed(df, name, *storage), Layer.MARTS.table(name), None if storage else contract, partition_by)
        return spark.table(Layer.MARTS.table(name))

    rebuild("dim_labels", dims.labels_of(fresh_table(spark, LABEL_COUNTS)))
    people = rebuild("dim_contributors", with_bucket(dims.contributors_of_counts(counted)), BUCKET)
    monthly = facts.activity_monthly_of_counts(counted, people)
    rebuild("fct_contributor_activity_monthly", with_bucket(monthly), BUCKET)
    pulls = facts.fct_pull_requests(staged["stg_pull_requests"], repositories, people, salts)
    rebuild("fct_pull_requests", pulls, OPENED_PARTITION)
    rebuild("fct_issues", facts.fct_issues(staged["stg_issues"], repositories, people, salts), OPENED_PARTITION)
    labelled = staging.stg_issue_labels(raw["issues"], [MONTH] if MONTH in raw["issues"].columns else [])
    if MONTH not in labelled.columns:
        labelled = labelled.withColumn(MONTH, F.lit(None).cast("string"))
    rebuild("bridge_issue_labels", facts.bridge_issue_labels(labelled, [MONTH]), MONTH)
    done = WriteGroup(spark, Layer.INTERMEDIATE.value)
    _end_batches(done, batches)
    done.commit()


def assert_types(df: DataFrame, name: str) -> None:
    from osspulse.sinks import assert_contract

    assert_contract(df.select(*(c for c in df.columns if c in schemas.MARTS[name].fieldNames())), schemas.MARTS[name])


def _end_batches(group: WriteGroup, batches: Mapping[str, list[str]]) -> None:
    for endpoint, numbers in batches.items():
        if numbers:
            group.drop_partitions(change_log(endpoint), BATCH, numbers)


def version_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """`name` and `since`: repositories with a version that is new, gone or of another range, and the first day it matters for."""
    columns = ["repository_key", "repository_name", "valid_from", "valid_to"]
    sides = old.select(F.lit(-1).alias(SIGN), *columns).unionByName(new.select(F.lit(1).alias(SIGN), *columns))
    changed = net(sides)
    # A version that only ends on another day matters from the earlier of its ends on.
    per_version = changed.groupBy("repository_key", "repository_name").agg(
        F.count(F.lit(1)).alias("sides"),
        F.min("valid_from").alias("from"),
        F.count_distinct("valid_from").alias("starts"),
        F.min("valid_to").alias("to"),
    )
    since = F.when((F.col("sides") == 2) & (F.col("starts") == 1), F.col("to")).otherwise(F.col("from"))
    return per_version.groupBy(F.col("repository_name").alias("name")).agg(F.min(since).alias("since"))


class Upkeep:
    """One round: the pending changes of the raw tables, applied to the stored marts."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], repositories: DataFrame, salts: int):
        self.spark, self.raw, self.salts = spark, raw, salts
        self.group = WriteGroup(spark, Layer.INTERMEDIATE.value)
        self.batches = pending_batches(spark)
        name = Layer.MARTS.table("dim_repositories")
        self.moved = cut_lineage(version_changes(fresh_table(spark, name), repositories))
        # Together with the facts, as what has moved follows from the difference to the stored versions.
        self.repositories = self.group.replace_table(repositories, name)
        self.since = self.moved.agg(F.date_format(F.min("since"), "yyyy-MM")).first()[0]
        self.changes = {endpoint: self._changes(endpoint) for endpoint in LOGGED}

    def _changes(self, endpoint: str) -> DataFrame:
        numbers = self.batches[endpoint]
        if not numbers:
            raw = self.raw[endpoint]
            month = [] if MONTH in raw.columns else [F.lit(None).cast("string").alias(MONTH)]
            return raw.select("*", *month, F.lit(1).alias(SIGN)).limit(0)
        return fresh_table(self.spark, change_log(endpoint)).filter(F.col(BATCH).isin(numbers)).drop(BATCH)

    def run(self) -> None:
        people = self.persons()
        self.labels()
        stage = {
            "pull_requests": (staging.stg_pull_requests, "pr_number", "pr_key", "fct_pull_requests", facts.fct_pull_requests),
            "issues": (staging.stg_issues, "issue_number", "issue_key", "fct_issues", facts.fct_issues),
        }
        for endpoint, (plan, number, key, mart, build) in stage.items():
            self.fact(endpoint, plan, number, key, mart, lambda rows, build=build: build(rows, self.repositories, people, self.salts))
        self.bridge()
        _end_batches(self.group, self.batches)
        self.group.commit()

    def persons(self) -> DataFrame:
        """Counts, dimension and months of the persons that changes touch; returns the dimension with their new rows."""
        plans = (staging.stg_commits, staging.stg_issues, staging.stg_pull_requests)
        commits, issues, pulls = (through(self.changes[e], plan) for e, plan in zip(LOGGED, plans, strict=True))
        sides = []
        for side in (0, 1):
            rows = [split(x)[side] for x in (commits, pulls, issues)]
            sides.append(activity.login_events(*rows).withColumn(SIGN, F.lit(2 * side - 1)))
        changes = cut_lineage(with_bucket(count_changes(sides[0].unionByName(sides[1]), EVENT_KEYS)))
        touched = [row[0] for row in changes.select(BUCKET).distinct().collect()]
        dim = Layer.MARTS.table("dim_contributors")
        if not touched:
            return fresh_table(self.spark, dim)
        inside = F.col(BUCKET).isin(touched)
        state = fresh_table(self.spark, EVENTS).filter(inside)
        counted = with_bucket(add_counts(state, changes, EVENT_KEYS))
        counted = self.group.replace_partitions(counted, EVENTS, BUCKET, touched)
        logins = changes.select("username").distinct()
        theirs = counted.join(logins, "username", "left_semi")
        stored = fresh_table(self.spark, dim)
        rows = _placed(with_bucket(dims.contributors_of_counts(theirs)), "dim_contributors", BUCKET)
        fresh = self.group.replace_partitions(
            replace_keys(stored.filter(inside), logins, rows, ["username"]), dim, BUCKET, touched
        )
        mart = "fct_contributor_activity_monthly"
        months = _placed(with_bucket(facts.activity_monthly_of_counts(theirs, fresh)), mart, BUCKET)
        kept = fresh_table(self.spark, Layer.MARTS.table(mart)).filter(inside)
        self.group.replace_partitions(
            replace_keys(kept, logins, months, ["username"]), Layer.MARTS.table(mart), BUCKET, touched
        )
        return stored.filter(~inside).unionByName(fresh)

    def labels(self) -> None:
        of = lambda plan: lambda rows: plan(rows).select(*LABEL_KEYS)
        changes = through(self.changes["issues"], of(staging.stg_issue_labels)).unionByName(
            through(self.changes["pull_requests"], of(staging.stg_pr_labels))
        )
        counts = cut_lineage(count_changes(changes, LABEL_KEYS))
        if not counts.isEmpty():
            after = self.group.replace_table(add_counts(fresh_table(self.spark, LABEL_COUNTS), counts, LABEL_KEYS), LABEL_COUNTS)
            self.group.replace_table(dims.labels_of(after), Layer.MARTS.table("dim_labels"))

    def _moved_rows(self, endpoint: str, plan) -> DataFrame | None:
        """Staged records on or after the day on which their repository's versions changed."""
        if self.since is None:
            return None
        recent = self.raw[endpoint]
        if MONTH in recent.columns:
            recent = recent.filter(F.col(MONTH) >= self.since)
        rows = plan(recent).join(self.moved, F.col("repository") == F.col("name"))
        return rows.filter(F.to_date("created_at") >= F.col("since")).drop("name", "since")

    def fact(self, endpoint: str, plan, number: str, key: str, mart: str, build) -> None:
        changes = net(through(self.changes[endpoint], plan))
        named = surrogate_key(F.col("repository"), F.col(number)).alias(key)
        minus, plus = split(changes)
        rows, moved = plus, self._moved_rows(endpoint, plan)
        if moved is not None:
            rows = plus.unionByName(moved.join(plus.select("repository", number), ["repository", number], "left_anti"))
        rows = cut_lineage(rows)
        where = date_key(F.col("created_at")).alias(OPENED_PARTITION)
        gone = cut_lineage(minus.select(named, where).unionByName(rows.select(named, where)))
        touched = [row[0] for row in gone.select(OPENED_PARTITION).distinct().collect()]
        if not touched:
            return
        name = Layer.MARTS.table(mart)
        kept = fresh_table(self.spark, name).filter(in_partitions(OPENED_PARTITION, touched))
        after = replace_keys(kept, gone, build(rows), [key])
        self.group.replace_partitions(after, name, OPENED_PARTITION, touched)

    def bridge(self) -> None:
        """Labels of the changed issues as they now stand, in the months of these issues."""
        changes = self.changes["issues"]
        issue = surrogate_key(F.col("_repo"), F.col("number")).alias("issue_key")
        gone = cut_lineage(changes.select(issue, MONTH).distinct())
        touched = [row[0] for row in gone.select(MONTH).distinct().collect()]
        if not touched:
            return
        name = Layer.MARTS.table("bridge_issue_labels")
        recent = self.raw["issues"].filter(in_partitions(MONTH, touched))
        current = facts.bridge_issue_labels(staging.stg_issue_labels(recent, [MONTH]), [MONTH])
        rows = current.join(gone.select("issue_key"), "issue_key", "left_semi").select("issue_key", "label_key", MONTH)
        kept = fresh_table(self.spark, name).filter(in_partitions(MONTH, touched))
        self.group.replace_partitions(replace_keys(kept, gone, rows, ["issue_key"]), name, MONTH, touched)
