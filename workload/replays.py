"""Loads replayed one after the other: marts kept up from signed changes, which end as the marts built from all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse import upkeep
from osspulse.functions import date_key, month_start
from osspulse.operators.bitmaps import numbered_persons, person_bitmaps, persons_in
from osspulse.operators.deltas import SIGN, add_counts, count_changes, replace_keys, signed
from osspulse.operators.numbering import row_numbers
from osspulse.operators.ordered_asof import ordered_asof
from osspulse.operators.selection import exact_median
from osspulse.plans import activity, dims, facts
from workload import mapping
from workload.mapping import Tables
from workload.marts import LazyMarts
from workload.registry import query

# When the two loads saw the records: the second one also repeats what it finds unchanged of its first days.
ORDERS, EVENTS = ("1999-06-01", "1998-06-01"), ("2024-01-20", "2024-01-12")


def _loads(rows: DataFrame, opened: str, done: str | None, times: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """What the first load had, and the second one: rows that are new, have ended, or are simply landed again.

    What ended later was open in the first load, and had another author.
    """
    ends, starts = (F.lit(x).cast("timestamp_ntz") for x in times)
    first = rows.filter(F.col(opened).isNull() | (F.col(opened) < ends))
    second = F.col(opened) >= starts
    if done is not None:
        later = F.coalesce(F.col(done) >= ends, F.lit(False))
        first = first.withColumns(
            {"author_login": F.when(later, F.lit("ghost")).otherwise(F.col("author_login")), done: F.when(~later, F.col(done))}
        )
        second = second | later
    return first, rows.filter(second)


class Replay:
    """The first load's rows, and the changes that the second one made: rows replaced and rows new."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.m = LazyMarts(spark, sf_dir)
        t = self.m.t
        self.commits = _loads(mapping.commits(t), "committed_at", None, ORDERS)
        self.pulls = _loads(mapping.pull_requests(t), "created_at", "merged_at", ORDERS)
        self.issues = _loads(mapping.issues(t), "created_at", "closed_at", EVENTS)

    def changes(self, loads: tuple[DataFrame, DataFrame], keys: Sequence[str]) -> DataFrame:
        first, second = loads
        return signed(first.join(second.select(*keys), list(keys), "left_semi"), second)

    def counted(self) -> DataFrame:
        """Events per login, kind, repository and day after both loads: the first load's counts and the signs of the second."""
        # Line items share a hash here; with its moment it is a key.
        keys = (["commit_sha", "committed_at"], ["repository", "pr_number"], ["repository", "issue_number"])
        loads = (self.commits, self.pulls, self.issues)
        before = activity.login_events(*(first for first, _ in loads)).groupBy(*upkeep.EVENT_KEYS).agg(F.count(F.lit(1)).alias("n"))
        sides = []
        for sign in (-1, 1):
            rows = [self.changes(x, k).filter(F.col(SIGN) == sign).drop(SIGN) for x, k in zip(loads, keys, strict=True)]
            sides.append(activity.login_events(*rows).withColumn(SIGN, F.lit(sign)))
        return add_counts(before, count_changes(sides[0].unionByName(sides[1]), upkeep.EVENT_KEYS), upkeep.EVENT_KEYS)


@query
def replayed_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.contributors_of_counts(Replay(spark, sf_dir).counted())


@query
def replayed_activity_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = Replay(spark, sf_dir).counted()
    return facts.activity_monthly_of_counts(counted, dims.contributors_of_counts(counted))


@query
def replayed_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the first load with its repository versions; changed rows and those of changed versions are made again."""
    r = Replay(spark, sf_dir)
    first, second = r.pulls
    history = mapping.history(r.m.t)
    then = F.lit(ORDERS[0]).cast("timestamp_ntz")
    known = history.filter(F.col("dbt_valid_from") < then)
    known = known.withColumn("dbt_valid_to", F.when(F.col("dbt_valid_to") < then, F.col("dbt_valid_to")))
    old, new = dims.dim_repositories(known), dims.dim_repositories(history)
    people = r.m["dim_contributors"]
    ghost = people.limit(1).withColumn("username", F.lit("ghost"))
    before = facts.fct_pull_requests(first, old, people.unionByName(ghost))
    moved = upkeep.version_changes(old, new)
    both = mapping.pull_requests(r.m.t).join(moved, F.col("repository") == F.col("name"))
    both = both.filter(F.to_date("created_at") >= F.col("since")).drop("name", "since")
    keys = ["repository", "pr_number"]
    rows = second.unionByName(both.join(second.select(*keys), keys, "left_anti"))
    fresh = facts.fct_pull_requests(rows, new, people)
    return replace_keys(before, fresh, fresh, ["pr_key"])


@query
def replayed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of pull requests and issues as counts; those of the last issues come as changes and some colors go."""
    t = Tables(spark, sf_dir)
    labels, keys = mapping.issue_labels(t).select("issue_number", *upkeep.LABEL_KEYS), upkeep.LABEL_KEYS
    half = labels.agg(F.avg("issue_number")).scalar()
    marked = labels.withColumn("late", F.col("issue_number") > half)
    # The first load had another color for the labels of late issues.
    wrong = marked.filter("late").withColumn("label_color", F.lit("zzz")).select(*keys)
    right, kept = marked.filter("late").select(*keys), marked.filter("not late").select(*keys)
    before = kept.unionByName(wrong).unionByName(mapping.pr_labels(t).select(*keys))
    before = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return dims.labels_of(add_counts(before, count_changes(signed(wrong, right), keys), keys))


@query
def asof_by_ordered_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version of each pull request's repository from one ordered stream of versions and events."""
    m = LazyMarts(spark, sf_dir)
    versions = dims.dim_repositories(mapping.history(m.t)).select(
        "repository_name", "valid_from", "valid_to", "repository_key", "description"
    )
    pulls = mapping.pull_requests(m.t).select("repository", "pr_number", F.to_date("created_at").alias("day"))
    found = ordered_asof(pulls, versions, ["repository"], "day", ["repository_name"], "valid_from", "valid_to", ["repository_key", "description"])
    return found.select("repository", "pr_number", "repository_key", "description")


@query
def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its place by price and key: no window without a partition, no row-at-a-time Python."""
    orders = Tables(spark, sf_dir)["orders"].select("o_orderkey", "o_totalprice")
    return row_numbers(orders, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()], "position")


def _months(m: LazyMarts) -> tuple[DataFrame, DataFrame]:
    """Numbered persons, and their bitmaps per repository and month of commits."""
    commits = mapping.commits(m.t).filter(F.col("author_login").isNotNull())
    commits = commits.select("repository", F.to_date(month_start(F.to_date("committed_at"))).alias("month"), F.col("author_login").alias("username"))
    persons = numbered_persons(m["dim_contributors"].select("username"))
    return persons, person_bitmaps(commits, persons, ["repository", "month"])


@query
def bitmap_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct authors per repository, over all months, by union of stored bitmaps."""
    _, bitmaps = _months(LazyMarts(spark, sf_dir))
    return persons_in(bitmaps, ["repository"])


@query
def bitmap_contributors_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bitmaps = _months(LazyMarts(spark, sf_dir))
    return persons_in(bitmaps, ["month"])


@query
def bitmap_contributors_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All distinct authors of a range of months, in one number."""
    _, bitmaps = _months(LazyMarts(spark, sf_dir))
    return persons_in(bitmaps.filter(F.col("month").between("1997-03-01", "1999-06-01")), [])


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many issues of a repository were opened in each microsecond."""
    issues = mapping.issues(Tables(spark, sf_dir))
    moment = F.unix_micros(F.col("created_at").cast("timestamp")).alias("moment")
    return issues.select("repository", moment).groupBy("repository", "moment").agg(F.count(F.lit(1)).alias("n"))


@query
def issue_midpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moment by which half of a repository's issues had been opened, among nearly as many distinct moments as issues."""
    return exact_median(_moments(spark, sf_dir), ["repository"], "moment", "n", "midpoint_us")


@query
def issue_midpoint_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all issues: one group that holds every row."""
    return exact_median(_moments(spark, sf_dir), [], "moment", "n", "midpoint_us")
