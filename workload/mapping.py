"""Benchmark tables in the roles of the engine's staged inputs.

Orders are pull requests, line items commits, events issues and downloads, nations repositories.
`workload.oracle` states the same views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.schemas import BIGINT, INT, STRING, TIMESTAMP_NTZ, record

DOUBLE = T.DoubleType()


# Stated, so that setting up a query reads no file footers.
SCHEMAS: dict[str, T.StructType] = {
    "nation": record(n_nationkey=INT, n_name=STRING, n_regionkey=INT),
    "customer": record(
        c_custkey=BIGINT, c_name=STRING, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=STRING
    ),
    "supplier": record(s_suppkey=BIGINT, s_name=STRING, s_nationkey=INT, s_acctbal=DOUBLE),
    "part": record(
        p_partkey=BIGINT, p_name=STRING, p_brand=STRING, p_type=STRING, p_size=INT, p_retailprice=DOUBLE
    ),
    "orders": record(
        o_orderkey=BIGINT, o_custkey=BIGINT, o_orderstatus=STRING, o_totalprice=DOUBLE,
        o_orderdate=TIMESTAMP_NTZ, o_orderpriority=STRING,
    ),
    "lineitem": record(
        l_orderkey=BIGINT, l_partkey=BIGINT, l_suppkey=BIGINT, l_linenumber=INT, l_quantity=DOUBLE,
        l_extendedprice=DOUBLE, l_discount=DOUBLE, l_tax=DOUBLE, l_returnflag=STRING, l_linestatus=STRING,
        l_shipdate=TIMESTAMP_NTZ,
    ),
    "events": record(
        event_id=BIGINT, ts=TIMESTAMP_NTZ, user_id=BIGINT, event_type=STRING, value=DOUBLE, props=STRING
    ),
    "region": record(r_regionkey=INT, r_name=STRING),
    "embeddings": record(vec_id=BIGINT),
    "pages": record(page_id=BIGINT, url=STRING, html=STRING),
    "benchmark": record(item_id=BIGINT, text=STRING),
    "labels": record(doc_id=BIGINT, quality=INT, toxic=INT),
    "documents": record(doc_id=BIGINT, text=STRING, lang=STRING, source=STRING, n_chars=BIGINT),
    "conversations": record(conv_id=BIGINT, turn=BIGINT, role=STRING, text=STRING),
}


class Tables:
    """The tables of one data directory, and the views over them; each is set up once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            reader = self.spark.read.schema(SCHEMAS[name])
            self.frames[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.frames[name]


def view(define: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    @wraps(define)
    def once(t: Tables) -> DataFrame:
        key = f"view {define.__name__}"
        if key not in t.frames:
            t.frames[key] = define(t)
        return t.frames[key]

    return once


@view
def _orders_by_nation(t: Tables) -> DataFrame:
    customer = t["customer"].select("c_custkey", "c_name", "c_nationkey")
    nation = t["nation"].select("n_nationkey", "n_name")
    return (
        t["orders"]
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )


@view
def pull_requests(t: Tables) -> DataFrame:
    """Merged at the first shipment on or after the order date, for finished orders."""
    shipped = t["lineitem"].select("l_orderkey", "l_shipdate")
    order = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    in_time = F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate"))
    # One shuffle by order serves the join and the aggregate.
    first = (
        t["orders"]
        .select(*order)
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy(*order)
        .agg(F.min(in_time).alias("first_ship"))
    )
    customer = t["customer"].select("c_custkey", "c_name", "c_nationkey")
    nation = t["nation"].select("n_nationkey", "n_name")
    return (
        first.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("repository"),
            F.col("o_orderkey").alias("pr_number"),
            F.col("c_name").alias("author_login"),
            F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
            F.col("o_orderdate").alias("created_at"),
            F.when(F.col("o_orderstatus") == "F", F.col("first_ship")).alias("merged_at"),
            F.col("o_orderdate").alias("_loaded_at"),
        )
    )


@view
def commits(t: Tables) -> DataFrame:
    """The supplier's nation is the repository, the customer the author; open new lines have none."""
    orders = t["orders"].select("o_orderkey", "o_custkey")
    customer = t["customer"].select("c_custkey", "c_name")
    supplier = t["supplier"].select("s_suppkey", "s_nationkey")
    nation = t["nation"].select("n_nationkey", "n_name")
    unattributed = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    return (
        t["lineitem"]
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("commit_sha"),
            F.col("n_name").alias("repository"),
            F.when(~unattributed, F.col("c_name")).alias("author_login"),
            F.col("l_shipdate").alias("committed_at"),
            F.col("l_shipdate").alias("_loaded_at"),
        )
    )


def _digits(props: str):
    return F.regexp_replace(props, "[^0-9]", "").cast("bigint")


@view
def issues(t: Tables) -> DataFrame:
    """Errors and views stay open; the others close after ten minutes per unit of value."""
    still_open = F.col("event_type").isin("error", "view")
    minutes = F.floor(F.col("value") * 10).cast("int")
    closed_at = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    nation = t["nation"].select("n_nationkey", "n_name")
    return (
        t["events"]
        .join(nation, F.col("user_id") % 25 == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("repository"),
            F.col("event_id").alias("issue_number"),
            F.concat(F.lit("u"), F.col("user_id")).alias("author_login"),
            F.when(still_open, "open").otherwise("closed").alias("state"),
            F.col("ts").alias("created_at"),
            F.when(~still_open, closed_at).alias("closed_at"),
            _digits("props").alias("comment_count"),
            F.col("ts").alias("_loaded_at"),
        )
    )


@view
def releases(t: Tables) -> DataFrame:
    """Every order; open ones are drafts."""
    return _orders_by_nation(t).select(
        F.col("o_orderkey").alias("release_id"),
        F.col("n_name").alias("repository"),
        F.concat(F.lit("v"), F.col("o_orderkey")).alias("tag_name"),
        F.concat(F.lit("Version "), F.col("o_orderkey")).alias("name"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("published_at"),
        F.col("o_orderdate").alias("_loaded_at"),
    )


@view
def pr_labels(t: Tables) -> DataFrame:
    """A part's type as label name and its brand as color, per line of an order."""
    part = t["part"].select("p_partkey", "p_type", "p_brand")
    lines = t["lineitem"].select("l_orderkey", "l_partkey")
    nations = _orders_by_nation(t).select("o_orderkey", "n_name")
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(nations, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("n_name").alias("repository"),
            F.col("l_orderkey").alias("pr_number"),
            F.col("p_type").alias("label_name"),
            F.col("p_brand").alias("label_color"),
        )
    )


@view
def issue_labels(t: Tables) -> DataFrame:
    """Two labels per event: its type, and the tens of the number in its properties."""
    nation = t["nation"].select("n_nationkey", "n_name")
    kind = F.struct(F.col("event_type").alias("label_name"), F.lit("ff0000").alias("label_color"))
    area = F.struct(
        F.concat(F.lit("area-"), F.floor(_digits("props") / 10)).alias("label_name"),
        F.col("event_type").alias("label_color"),
    )
    return (
        t["events"]
        .join(nation, F.col("user_id") % 25 == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("repository"),
            F.col("event_id").alias("issue_number"),
            F.inline(F.array(kind, area)),
        )
    )


@view
def download_log(t: Tables) -> DataFrame:
    """Errors come from a mirror, signups do not report an installer."""
    installer = F.when(F.col("event_type") == "error", "bandersnatch").when(
        F.col("event_type") != "signup", "pip"
    )
    return t["events"].select(
        F.to_date("ts").alias("dt"),
        F.concat(F.lit("pkg"), F.col("user_id") % 30).alias("project"),
        installer.alias("installer"),
        "ts",
    )


@view
def projects(t: Tables) -> DataFrame:
    """A package per nation, except in region 4; packages 25 to 29 have no repository."""
    package = F.when(F.col("n_regionkey") != 4, F.concat(F.lit("pkg"), F.col("n_nationkey")))
    return t["nation"].select(F.col("n_name").alias("repo"), package.alias("package"))


@view
def repositories_now(t: Tables) -> DataFrame:
    """Monthly captures: customers as stars, orders as forks, open orders as open issues."""
    month = F.trunc(F.to_date("o_orderdate"), "month").cast("timestamp_ntz")
    return (
        _orders_by_nation(t)
        .groupBy(
            F.col("n_nationkey").cast("bigint").alias("repository_id"),
            F.col("n_name").alias("repository_name"),
            month.alias("_loaded_at"),
        )
        .agg(
            F.count_distinct("o_custkey").alias("stars"),
            F.count("*").alias("forks"),
            F.count_if(F.col("o_orderstatus") == "O").alias("open_issues"),
        )
    )


@view
def history(t: Tables) -> DataFrame:
    """A version per nation and order year. The set holds the years of one nation."""
    nations = (
        _orders_by_nation(t)
        .groupBy(F.col("n_nationkey").cast("bigint").alias("repository_id"))
        .agg(
            F.max("n_name").alias("repository_name"),
            F.array_sort(F.collect_set(F.year("o_orderdate"))).alias("years"),
        )
    )

    def version(year: Column, position: Column) -> Column:
        return F.struct(year.alias("y"), F.get("years", position + 1).alias("next_y"))

    years = nations.select(
        "repository_id", "repository_name", F.inline(F.transform("years", version))
    )

    def new_year(year: str) -> Column:
        return F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz")

    opened, closed = new_year("y"), new_year("next_y")
    return years.select(
        "repository_id",
        "repository_name",
        F.lower("repository_name").alias("name"),
        F.lit("nations").alias("owner_login"),
        F.concat(F.lit("as of "), F.col("y")).alias("description"),
        F.when(F.col("repository_id") % 2 == 0, "Python").otherwise("Rust").alias("language"),
        F.lit("MIT").alias("license_spdx"),
        F.concat(F.lit("topic"), F.col("y")).alias("topics"),
        F.lit("1990-01-01").cast("timestamp_ntz").alias("created_at"),
        opened.alias("updated_at"),
        opened.alias("dbt_valid_from"),
        closed.alias("dbt_valid_to"),
    )
