"""Queries that SQL can express, against it, types included."""

from __future__ import annotations

import oracle_compare as oracle
import pytest

from osspulse.llm.oracle import ORACLE
from osspulse.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    connection, df = oracle.connect(sf_dir), QUERIES[name](spark, sf_dir)
    assert oracle.spark_rows(df) == oracle.sql_rows(connection, ORACLE[name])
    assert oracle.type_differences(df, connection, ORACLE[name]) == {}
