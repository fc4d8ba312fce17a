"""Registered queries: name to callable over (session, data directory)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse.operators import (
    after_watermark,
    child_rows,
    delete_insert,
    flatten_struct,
    scd2_join,
    scd2_snapshot,
    upsert,
)
from osspulse.pipeline import after_cursor
from osspulse.plans import dims, metrics, queries, staging
from osspulse.quality import checks
from osspulse.sources import daily_downloads, spine_between
from workload import mapping
from workload.mapping import Tables
from workload.marts import LazyMarts

Query = Callable[[SparkSession, str], DataFrame]

# "Now" of the benchmark: shortly after its last order.
AS_OF = datetime(2001, 8, 15)
# Where the two loads of the merge queries part.
FIRST_LOAD_ENDS, SECOND_LOAD_STARTS = "1999-06-01", "1998-06-01"

REGISTRY: dict[str, Query] = {}


def query(function: Callable) -> Callable:
    """Register under the function's name."""
    REGISTRY[function.__name__] = function
    return function


# Questions that need nothing but marts, and so also run on stored ones.
QUESTIONS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {}


def question(name: str, plan: Callable[[LazyMarts], DataFrame]) -> None:
    """Register a plan over the marts."""
    REGISTRY[name] = lambda spark, sf_dir: plan(LazyMarts(spark, sf_dir))


def mart_question(name: str, plan: Callable[[LazyMarts], DataFrame]) -> None:
    QUESTIONS[name] = plan
    question(name, plan)


# ----- models -----
for _name in (
    "dim_contributors",
    "dim_repositories",
    "dim_labels",
    "fct_commits",
    "fct_pull_requests",
    "fct_issues",
    "fct_releases",
    "fct_daily_downloads",
    "fct_repository_metrics",
    "fct_contributor_activity_monthly",
    "bridge_issue_labels",
    "contributor_activity",
):
    question(_name, lambda m, _name=_name: m[_name])

question("date_keys", lambda m: _date_keys(m.t))


def _date_keys(t: Tables) -> DataFrame:
    from osspulse.functions import date_key, day_diff, hour_diff, month_diff, month_start

    pulls = mapping.pull_requests(t)
    opened, merged = F.col("created_at"), F.col("merged_at")
    return pulls.select(
        "pr_number",
        date_key(opened).alias("opened_key"),
        date_key(merged).alias("merged_key"),
        month_start(opened).alias("opened_month"),
        hour_diff(opened, merged).alias("hours"),
        day_diff(opened, merged).alias("days"),
        month_diff(opened, merged).alias("months"),
    )


@query
def dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the span of the orders."""
    bounds = Tables(spark, sf_dir)["orders"].agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.date_add(F.to_date(F.max("o_orderdate")), 1).alias("end_day"),
    )
    return dims.calendar(spine_between(bounds))


@query
def scd2_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version of the repository on the opening day of each pull request, salted by day."""
    m = LazyMarts(spark, sf_dir)
    rows = scd2_join(
        mapping.pull_requests(m.t),
        dims.dim_repositories(mapping.history(m.t)),
        F.col("repository"),
        F.to_date("created_at"),
        take=("repository_key", "description"),
        salts=4,
    )
    return rows.select("repository", "pr_number", "repository_key", "description")


@query
def package_downloads_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-mirror downloads per package and day."""
    return daily_downloads(
        mapping.download_log(Tables(spark, sf_dir)),
        days=None,
        packages=None,
        package=F.col("project"),
        installer=F.col("installer"),
    )


@query
def topics_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of each document source as a repository's sorted topics."""
    raw = (
        Tables(spark, sf_dir)["documents"]
        .groupBy("source")
        .agg(F.count("*").alias("stars"), F.collect_set("lang").alias("topics"))
    )
    text = staging.sorted_text("topics")
    return raw.select(F.col("source").alias("repository_name"), text.alias("topics"), "stars")


@query
def label_child_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue labels nested into their event, exploded to child rows and counted."""
    event = Tables(spark, sf_dir)["events"].select(
        "user_id", F.array("event_type", F.concat(F.lit("k"), F.length("props"))).alias("labels")
    )
    return child_rows(event, "labels", ["user_id"]).groupBy("user_id", "value").agg(F.count("*").alias("n"))


@query
def non_merge_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as commits with as many parents as turns before."""
    parent = F.struct(F.lit("p").alias("sha"), F.lit("u").alias("url"))
    turns = Tables(spark, sf_dir)["conversations"]
    author = F.struct(
        F.struct(
            F.col("role").alias("name"),
            F.lit(None).cast("string").alias("email"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("date"),
        ).alias("author"),
        F.lit("turn").alias("message"),
    )
    raw = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("sha"),
        F.col("role").alias("_repo"),
        F.struct(F.col("role").alias("login")).alias("author"),
        author.alias("commit"),
        F.array_repeat(parent, F.col("turn").cast("int")).alias("parents"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("_loaded_at"),
    )
    return staging.stg_commits(raw).select("commit_sha", "repository", "author_login")


@query
def flattened_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders nested two levels deep and flattened to path-named columns."""
    status = F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("priority"))
    owner = F.struct(F.col("o_custkey").alias("id"), status.alias("status"))
    orders = Tables(spark, sf_dir)["orders"].select(F.col("o_orderkey").alias("id"), owner.alias("owner"))
    return flatten_struct(orders)


# ----- questions -----
def _region(t: Tables, region: int) -> DataFrame:
    return t["nation"].filter(F.col("n_regionkey") == region).select("n_name")


mart_question("all_repo_names", queries.all_repo_names)
mart_question("overview_kpis", queries.overview_kpis)
mart_question("repo_snapshot", queries.repo_snapshot)
mart_question("commits_per_month", queries.commits_per_month)
mart_question("stars_forks_over_time", queries.stars_forks_over_time)
mart_question("downloads_over_time", queries.downloads_over_time)
mart_question("downloads_vs_stars", queries.downloads_vs_stars)
mart_question("health_components", lambda m: queries.health_components(m, AS_OF))
mart_question("pr_velocity_monthly", queries.pr_velocity_monthly)
mart_question("pr_throughput_monthly", queries.pr_throughput_monthly)
mart_question("issue_resolution_monthly", queries.issue_resolution_monthly)
mart_question("issue_label_breakdown", queries.issue_label_breakdown)
mart_question("commit_share", queries.commit_share)
mart_question("contributor_leaderboard", queries.contributor_leaderboard)
mart_question("retention_cohort", queries.retention_cohort)
mart_question("active_contributors_monthly", queries.active_contributors_monthly)
mart_question("multi_project_contributors", queries.multi_project_contributors)
mart_question("releases", queries.releases)
mart_question("release_gaps", queries.release_gaps)
mart_question("date_bounds", queries.date_bounds)
mart_question(
    "pr_velocity_between",
    lambda m: queries.pr_velocity_monthly(m, None, date(1997, 3, 15), date(1999, 6, 20)),
)
question("commits_per_month_of_region", lambda m: queries.commits_per_month(m, _region(m.t, 1)))
mart_question("bus_factor", lambda m: metrics.bus_factor(queries.commit_share(m)))
mart_question("lorenz_curve", lambda m: metrics.lorenz_curve(queries.commit_share(m)))
mart_question("retention_heatmap", lambda m: metrics.retention_heatmap(queries.retention_cohort(m)))
mart_question("release_cadence", lambda m: metrics.release_cadence(queries.release_gap_counts(m)))
mart_question("release_gap_histogram", lambda m: metrics.release_gap_histogram(queries.release_gap_counts(m)))
mart_question("label_states_long", lambda m: metrics.label_states_long(queries.issue_label_breakdown(m)))
mart_question("series_status", lambda m: metrics.series_status(queries.stars_forks_over_time(m), "date"))
mart_question("downloads_ready", lambda m: metrics.has_downloads(queries.downloads_vs_stars(m)))


def _health_score(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Rounded: logarithms and powers differ between engines in the last bits."""
    scored = metrics.compute_health(queries.health_components(marts, AS_OF))
    names = [*metrics.WEIGHTS, "health_score"]
    return scored.select("repository_name", *(F.round(name, 9).alias(name) for name in names))


mart_question("health_score", _health_score)


# ----- merges and history -----
def _load(t: Tables, number: int, kept: Column) -> DataFrame:
    return t["orders"].filter(kept).select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        (F.col("o_totalprice") + number - 1).alias("o_totalprice"),
        F.lit(number).cast("bigint").alias("load"),
    )


def _two_loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The first load holds the older orders, the second the newer ones; a year is in both."""
    day = F.col("o_orderdate")
    return _load(t, 1, day < FIRST_LOAD_ENDS), _load(t, 2, day >= SECOND_LOAD_STARTS)


@query
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load, then both loads as one batch with repeated keys: newest load wins."""
    first, second = _two_loads(Tables(spark, sf_dir))
    return upsert(first, first.unionByName(second), ["o_orderkey"], ["load"])


@query
def keyed_delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer in the second load loses the orders of the first one."""
    first, second = _two_loads(Tables(spark, sf_dir))
    return delete_insert(first, second, ["o_custkey"])


@query
def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second load bounded, inclusively, by the newest day of the first; then delete and insert."""
    first, second = _two_loads(Tables(spark, sf_dir))
    mark = first.agg(F.max("o_orderdate")).scalar()
    return delete_insert(first, after_watermark(second, F.col("o_orderdate"), mark), ["o_orderkey"])


@query
def cursor_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second load bounded by each customer's newest order in the first; new customers in full."""
    first, second = _two_loads(Tables(spark, sf_dir))
    return after_cursor(second, first, "o_orderdate", ["o_custkey"])


@query
def late_days_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day that a day watermark leaves out of the second load."""
    first, second = _two_loads(Tables(spark, sf_dir))
    mark = first.agg(F.max("o_orderdate")).scalar()
    loaded = after_watermark(second, F.col("o_orderdate"), mark)
    late = second.join(loaded.select("o_orderkey"), "o_orderkey", "left_anti")
    return late.groupBy("o_orderdate").agg(F.count("*").alias("orders"))


@query
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers seen twice: some are new, some gone, some changed segment, some lost theirs."""
    t = Tables(spark, sf_dir)
    customer = t["customer"].select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    opened = F.lit("2024-01-01").cast("timestamp_ntz")
    history = (
        customer.filter(F.col("c_mktsegment") != "BUILDING")
        .select("c_custkey", "c_name", "c_mktsegment")
        .withColumns({"dbt_valid_from": opened, "dbt_valid_to": F.lit(None).cast("timestamp_ntz")})
    )
    segment = F.when(F.col("c_acctbal") < 0, F.lit("ARREARS")).when(
        F.col("c_nationkey") != 3, F.col("c_mktsegment")
    )
    current = customer.filter(F.col("c_mktsegment") != "MACHINERY").select(
        "c_custkey", "c_name", segment.alias("c_mktsegment")
    )
    run_ts = F.lit("2024-02-01").cast("timestamp_ntz")
    return scd2_snapshot(history, current, "c_custkey", ["c_mktsegment"], run_ts)


# ----- quality -----
def violations(name: str, plan: Callable[[LazyMarts], DataFrame]) -> None:
    question(f"dq_{name}", plan)


violations(
    "not_null",
    lambda m: checks.not_null("author_login").violations(mapping.commits(m.t)).select("commit_sha"),
)
violations("unique", lambda m: checks.unique("author_login").violations(mapping.issues(m.t)))
violations(
    "unique_combination",
    lambda m: checks.unique("repository", "pr_number", "label_name").violations(mapping.pr_labels(m.t)),
)
violations(
    "accepted_values",
    lambda m: checks.accepted_values("event_type", ["view", "click", "signup"])
    .violations(m.t["events"])
    .select("event_id", "event_type"),
)
violations(
    "relationships",
    lambda m: checks.relationships(
        "o_custkey", m.t["customer"].filter(F.col("c_acctbal") > 0), "c_custkey"
    ).violations(m.t["orders"]),
)
violations(
    "ranges",
    lambda m: checks.adjacent_ranges("n_nationkey", "opened", "closed").violations(_ranges(m.t)),
)
violations("row_count", lambda m: checks.row_count(1, 1000).violations(m["fct_issues"]))
violations(
    "between",
    lambda m: checks.between("time_to_close_hours", 0, 24, where="is_closed")
    .violations(m["fct_issues"])
    .select("issue_key", "time_to_close_hours"),
)
violations(
    "expression",
    lambda m: checks.expression("stars * 2 >= forks + open_issues")
    .violations(m["fct_repository_metrics"])
    .select("metric_key", "stars", "forks", "open_issues"),
)
violations("calendar", lambda m: checks.missing_days(_release_days(m.t), "full_date"))
violations(
    "freshness",
    lambda m: checks.freshness(
        {"events": m.t["events"].withColumnRenamed("ts", "_loaded_at"), "releases": mapping.releases(m.t)},
        datetime(2024, 1, 31, 18),
        warn_hours=12,
        error_hours=24,
    ),
)


def _ranges(t: Tables) -> DataFrame:
    """Release days of a nation with an end 30 days on: gaps and overlaps."""
    days = mapping.releases(t).select("repository", F.to_date("published_at").alias("opened"))
    nation = t["nation"].select("n_nationkey", "n_name")
    return (
        days.filter(F.col("opened").isNotNull())
        .distinct()
        .join(nation, F.col("repository") == F.col("n_name"))
        .select("n_nationkey", "opened", F.date_add("opened", 30).alias("closed"))
    )


def _release_days(t: Tables) -> DataFrame:
    day = F.to_date("published_at").alias("full_date")
    return mapping.releases(t).select(day).filter(F.col("full_date").isNotNull()).distinct()


@query
def dq_run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of the issue fact in one summary."""
    m = LazyMarts(spark, sf_dir)
    suite = [
        checks.row_count(1, 10_000_000),
        checks.not_null("issue_key"),
        checks.unique("issue_key"),
        checks.not_null("repository_key"),
        checks.between("time_to_close_hours", 0, None, where="time_to_close_hours is not null", severity="warn"),
        checks.between("time_to_close_hours", 0, 24, where="is_closed", severity="warn"),
        checks.expression("comment_count >= 0"),
        checks.expression("comment_count < 50"),
        checks.relationships("author_key", m["dim_contributors"], "contributor_key"),
    ]
    return checks.run_checks(m["fct_issues"], suite)


@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table."""
    from osspulse.sinks import row_counts

    t = Tables(spark, sf_dir)
    return row_counts({name: t[name] for name in mapping.SCHEMAS})


from workload import landed, replays  # noqa: E402, F401  they register their queries
