"""Questions on data where one customer, supplier, user and day hold large shares of the rows."""

from __future__ import annotations

import duckdb
import oracle_compare as oracle
import pytest

import __spark_entry__ as contract

NAMES = [
    "bus_factor",
    "commit_share",
    "contributor_leaderboard",
    "dim_contributors",
    "fct_commits",
    "issue_resolution_monthly",
    "lorenz_curve",
    "pr_velocity_monthly",
    "release_gap_histogram",
    "release_gaps",
    "retention_cohort",
    "scd2_as_of_join",
]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory, sf_dir):
    out = tmp_path_factory.mktemp("hot")
    hot = {
        "orders": "case when o_orderkey % 5 < 2 then 1 else o_custkey end as o_custkey, "
        "case when o_orderkey % 5 < 2 then '1-URGENT' else o_orderpriority end as o_orderpriority, "
        "case when o_orderkey % 10 < 3 then timestamp '1998-02-03' else o_orderdate end as o_orderdate",
        "lineitem": "case when l_partkey % 5 < 2 then 1 else l_suppkey end as l_suppkey",
        "events": "case when event_id % 5 < 2 then 8 else user_id end as user_id",
    }
    connection = duckdb.connect()
    for table in oracle.TABLES:
        replaced = f" replace ({hot[table]})" if table in hot else ""
        source = f"select *{replaced} from '{sf_dir}/{table}.parquet'"
        connection.execute(f"copy ({source}) to '{out}/{table}.parquet' (format parquet)")
    return str(out)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, hot_dir, name):
    connection = oracle.connect(hot_dir)
    df = contract.queries()[name](spark, hot_dir)
    assert oracle.spark_rows(df) == oracle.sql_rows(connection, contract.oracle_sql()[name])
