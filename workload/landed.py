"""Benchmark tables nested into landed records, and the queries that clean them again."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse import schemas
from osspulse.functions import utc_literal
from osspulse.operators import by_repos, scd2_snapshot, upsert
from osspulse.operators.merge import latest_in_batch
from osspulse.operators.numbering import row_numbers
from osspulse.pipeline import RAW_TABLES, after_cursor, with_month
from osspulse.plans import dims, facts, queries, staging
from osspulse.plans.metrics import retention_heatmap
from osspulse.sources import attributed, daily_downloads, stamp, target_packages, target_repos
from workload import mapping
from workload.mapping import Tables
from workload.marts import LazyMarts
from workload.registry import mart_question, query

LANDED_ON = "2024-01-10"


def nested(**fields: Column | str) -> Column:
    return F.struct(*(F.col(v).alias(k) if isinstance(v, str) else v.alias(k) for k, v in fields.items()))


def through_json(rows: DataFrame, endpoint: str, owner: str, name: Column) -> DataFrame:
    """Records written as JSON text and read with the endpoint's schema, as landed files are."""
    text = F.to_json(F.struct(*(c for c in rows.columns if not c.startswith("_"))), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"})
    parsed = rows.select(
        F.from_json(text, schemas.ENDPOINTS[endpoint], {"mode": "FAILFAST"}).alias("r"),
        F.lit(LANDED_ON).cast("date").alias("load_day"),
        F.lit(owner).alias("repo_owner"),
        name.alias("repo_name"),
    )
    page = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("page-1.json").alias("file"))
    return attributed(parsed.select("r.*", "load_day", "repo_owner", "repo_name", page.alias("_page")), endpoint)


def raw_repositories(t: Tables) -> DataFrame:
    """Suppliers as repositories; the topics are out of order, and missing for some."""
    names = F.when(F.col("s_suppkey") % 3 != 0, F.array(F.lit("zinc"), F.concat(F.lit("n"), "s_nationkey"), F.lit("Alum")))
    rows = t["supplier"].select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("trade/"), "s_name").alias("full_name"),
        nested(login=F.lit("trade"), id=F.lit(1)).alias("owner"),
        F.when(F.col("s_acctbal") > 0, F.lit("solvent")).alias("description"),
        F.floor("s_acctbal").alias("stargazers_count"),
        F.col("s_nationkey").alias("forks_count"),
        F.lit(0).alias("open_issues_count"),
        F.lit("SQL").alias("language"),
        F.when(F.col("s_suppkey") % 2 == 0, nested(key=F.lit("mit"), spdx_id=F.lit("MIT"))).alias("license"),
        names.alias("topics"),
        F.lit("2020-01-01T00:00:00").alias("created_at"),
        F.lit("2024-01-01T00:00:00").alias("updated_at"),
    )
    return through_json(rows, "repositories", "trade", F.col("r.name"))


def raw_issues(t: Tables) -> DataFrame:
    """Events as issues; views are pull requests. Two labels, or none for clicks."""
    labels = F.array(nested(id=F.lit(1), name="event_type", color=F.lit("red")), nested(id=F.lit(2), name="props", color="event_type"))
    rows = t["events"].select(
        F.col("event_id").alias("number"),
        F.col("event_type").alias("title"),
        F.when(F.col("event_type") == "error", "open").otherwise("closed").alias("state"),
        F.when(F.col("user_id") % 7 != 0, nested(login=F.concat(F.lit("u"), "user_id"), id="user_id")).alias("user"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("created_at"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("updated_at"),
        F.when(F.col("event_type") != "error", F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("closed_at"),
        F.col("user_id").alias("comments"),
        F.when(F.col("event_type") != "click", labels).alias("labels"),
        F.when(F.col("event_type") == "view", nested(url=F.lit("https://x/1"))).alias("pull_request"),
    )
    return through_json(rows, "issues", "events", F.coalesce("r.title", F.lit("none")))


def raw_pull_requests(t: Tables) -> DataFrame:
    """Orders as pull requests, labelled with status and priority."""
    labels = F.array(nested(id=F.lit(1), name="o_orderstatus", color=F.lit("blue")), nested(id=F.lit(2), name="o_orderpriority", color=F.lit("grey")))
    rows = t["orders"].select(
        F.col("o_orderkey").alias("number"),
        F.lit("order").alias("title"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        nested(login=F.concat(F.lit("c"), "o_custkey"), id="o_custkey").alias("user"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("merged_at"),
        labels.alias("labels"),
    )
    return through_json(rows, "pull_requests", "orders", F.lit("all"))


def raw_releases(t: Tables) -> DataFrame:
    """Parts as releases; large ones are drafts."""
    rows = t["part"].select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("tag_name"),
        F.col("p_type").alias("name"),
        F.when(F.col("p_size") <= 40, F.lit("2023-05-06T07:08:09")).alias("published_at"),
    )
    return through_json(rows, "releases", "parts", F.lit("all"))


def raw_commits(t: Tables) -> DataFrame:
    """Lines of an order as commits: as many parents as earlier lines; returned ones have no date."""
    parent = nested(sha=F.lit("p"), url=F.lit("u"))
    author = nested(name=F.lit("n"), email=F.lit("e"), date=F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")))
    rows = t["lineitem"].select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("sha"),
        nested(author=author, message="l_linestatus").alias("commit"),
        nested(login=F.concat(F.lit("s"), "l_suppkey"), id="l_suppkey").alias("author"),
        F.array_repeat(parent, F.col("l_linenumber") - 1).alias("parents"),
    )
    return through_json(rows, "commits", "lines", F.lit("all"))


def _plain(df: DataFrame) -> DataFrame:
    """Moments without a zone, as the compared SQL has them."""
    moments = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType == schemas.TIMESTAMP}
    return df.withColumns(moments)


def _staged(name: str, model, raw) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(model(raw(Tables(spark, sf_dir))))

    run.__name__, run.__doc__ = name, f"`{name}` over landed records."
    query(run)


_staged("stg_repositories", staging.stg_repositories, raw_repositories)
_staged("stg_commits", staging.stg_commits, raw_commits)
_staged("stg_issues", staging.stg_issues, raw_issues)
_staged("stg_issue_labels", staging.stg_issue_labels, raw_issues)
_staged("stg_pull_requests", staging.stg_pull_requests, raw_pull_requests)
_staged("stg_pr_labels", staging.stg_pr_labels, raw_pull_requests)
_staged("stg_releases", staging.stg_releases, raw_releases)


@query
def landed_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per endpoint, repository and landing day, from the directories' names."""
    t = Tables(spark, sf_dir)
    endpoints = {"repositories": raw_repositories, "commits": raw_commits, "issues": raw_issues, "pull_requests": raw_pull_requests, "releases": raw_releases}
    parts = [raw(t).select(F.lit(name).alias("endpoint"), "_repo", F.to_date("_loaded_at").alias("day")) for name, raw in endpoints.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    counted = rows.groupBy("endpoint", F.split_part("_repo", F.lit("/"), F.lit(1)).alias("owner"), "day")
    return counted.agg(F.count("*").alias("records"), F.count_distinct("_repo").alias("repos"))


@query
def snap_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repository history over two captures: some changed their topics, some their stars only."""
    t = Tables(spark, sf_dir)
    first = staging.stg_repositories(raw_repositories(t))
    topics = F.when(F.col("repository_id") % 5 == 0, F.lit("renewed")).otherwise(F.col("topics"))
    second = first.withColumns({"topics": topics, "stars": F.col("stars") + 1})
    nothing = first.limit(0).withColumns({"dbt_valid_from": utc_literal(datetime(2024, 1, 1)), "dbt_valid_to": utc_literal(datetime(2024, 1, 1))})
    keys = ("repository_id", dims.VERSIONED_ATTRIBUTES)
    once = scd2_snapshot(nothing, first, *keys, utc_literal(datetime(2024, 1, 10)))
    twice = scd2_snapshot(once, second, *keys, utc_literal(datetime(2024, 1, 11)))
    return _plain(twice.select("repository_id", "topics", "stars", "dbt_valid_from", "dbt_valid_to"))


@query
def tracked_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories and packages of the projects list."""
    projects = mapping.projects(Tables(spark, sf_dir))
    repos = target_repos(projects).toDF("target").select(F.lit("repo").alias("kind"), "target")
    return repos.unionByName(target_packages(projects).toDF("target").select(F.lit("package").alias("kind"), "target"))


def _counted(spark: SparkSession, sf_dir: str, packages) -> DataFrame:
    log = mapping.download_log(Tables(spark, sf_dir))
    days = [date(2024, 1, 3), date(2024, 1, 5)]
    return daily_downloads(log, days, packages, package=F.col("project"), installer=F.col("installer"))


@query
def downloads_of_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, a list of packages."""
    return _counted(spark, sf_dir, ["pkg1", "pkg2", "pkg29"])


@query
def downloads_of_no_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty list keeps nothing."""
    return _counted(spark, sf_dir, [])


@query
def membership_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of listed customers, by list, by frame, by the empty list and by no list."""
    t = Tables(spark, sf_dir)
    orders = t["orders"].select(F.col("o_orderpriority").alias("name"))
    frame = t["orders"].filter("o_orderpriority like '1%'").select("o_orderpriority").distinct()
    choices = {"list": ["2-HIGH", "5-LOW"], "frame": frame, "empty": [], "all": None}
    rows = None
    for kind, chosen in choices.items():
        one = by_repos(orders, chosen, "name").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def repeated_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of downloads counted again after more events: its rows are replaced, other days stay."""
    log = mapping.download_log(Tables(spark, sf_dir))
    count = lambda rows, days: daily_downloads(rows, days, None, package=F.col("project"), installer=F.col("installer"))
    early = count(log.filter(F.hour("ts") < 12), None).withColumn("load", F.lit(1))
    again = count(log, date(2024, 1, 4)).withColumn("load", F.lit(2))
    return upsert(early, again, ["_package", "date"], ["load"])


@query
def metric_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture appended per day; a repeated day replaces its own."""
    t = Tables(spark, sf_dir)
    now = staging.stg_repositories(raw_repositories(t))
    versions = dims.dim_repositories(
        now.withColumns({"dbt_valid_from": utc_literal(datetime(2020, 1, 1)), "dbt_valid_to": F.lit(None).cast("timestamp")})
    )
    captures = [
        facts.fct_repository_metrics(
            now.withColumns({"_loaded_at": utc_literal(datetime(2024, 1, day, hour)), "stars": F.col("stars") + hour}), versions
        ).withColumn("load", F.lit(i))
        for i, (day, hour) in enumerate([(10, 1), (11, 2), (11, 3)])
    ]
    rows = captures[0]
    for later in captures[1:]:
        rows = upsert(rows, later, ["metric_key"], ["load"])
    return rows.select("repository_id", "repository_name", "date_key", "stars", "forks", "load")


# ----- what loads must keep -----
@query
def cursor_null_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits at or after the newest earlier one, and all that have no date."""
    commits = raw_commits(Tables(spark, sf_dir)).withColumn("at", F.col("commit.author.date"))
    earlier = commits.filter(F.col("at") < F.lit("1998-01-01").cast("timestamp"))
    kept = after_cursor(commits, earlier, "at")
    return kept.groupBy(F.col("at").isNull().alias("undated")).agg(F.count("*").alias("n"))


@query
def undated_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits by storage partition: one of its own for those without a date."""
    months = with_month(raw_commits(Tables(spark, sf_dir)), RAW_TABLES["commits"])
    return months.groupBy("_month").agg(F.count("*").alias("n"))


@query
def upsert_equal_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures with equal versions: the one that landed last wins."""
    rows = Tables(spark, sf_dir)["lineitem"].select(
        "l_orderkey", F.lit(1).alias("version"), F.col("l_shipdate").alias("landed"), F.col("l_linenumber").alias("page"), "l_partkey"
    )
    # Rows that tie in all of that go by their content, column by column.
    return latest_in_batch(rows, ["l_orderkey"], ["version", "landed", "page"])


mart_question("retention_heatmap_full", lambda m: retention_heatmap(queries.retention_cohort(m), None, None))


# ----- order -----
def _positions(df: DataFrame) -> DataFrame:
    """`df` with the place of each row in its order. Reads the order that came out, so it numbers rows of partitions."""
    return row_numbers(df, (), is_sorted=True)


def _ordered(name: str, plan) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _positions(plan(LazyMarts(spark, sf_dir)))

    run.__name__, run.__doc__ = name, "An ordered result with the place of each row."
    query(run)


_ordered("ordered_snapshot", lambda m: queries.repo_snapshot(m).select("repository_name", "stars"))
_ordered("ordered_label_breakdown", queries.issue_label_breakdown)
_ordered("ordered_leaderboard", queries.contributor_leaderboard)
_ordered("ordered_names", queries.all_repo_names)


def provenance_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant columns win over the record's own."""
    nation = Tables(spark, sf_dir)["nation"].select(F.col("n_name").alias("_repo"), "n_nationkey")
    return _plain(stamp(nation, datetime(2024, 1, 10, 3), _repo="a/a"))


query(provenance_stamp)
