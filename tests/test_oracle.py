"""Every registered query against its SQL, types included, on the smallest data."""

from __future__ import annotations

import oracle_compare as oracle
import pytest

import __spark_entry__ as contract
from workload.oracle import ORACLE as SQL
from workload.registry import REGISTRY as QUERIES



@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    assert oracle.spark_rows(df) == oracle.sql_rows(connection, SQL[name])
    assert oracle.type_differences(df, connection, SQL[name]) == {}
