from __future__ import annotations

from datetime import date, datetime

import pytest

from osspulse import schemas
from osspulse.quality import checks


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "open", 5), (2, "closed", -1), (2, None, None), (None, "odd", 7), (None, "open", 7)]
    return spark.createDataFrame(rows, "id int, state string, n int")


def found(check, df):
    return check.violations(df).count()


def test_row_checks(df):
    assert found(checks.not_null("id"), df) == 2
    assert found(checks.accepted_values("state", ["open", "closed"]), df) == 1
    assert found(checks.between("n", 0, None), df) == 1
    assert found(checks.between("n", 0, 6, where="state = 'open'"), df) == 1
    assert found(checks.expression("n >= 0"), df) == 1


def test_unique(df):
    assert [tuple(r) for r in checks.unique("id").violations(df).collect()] == [(2, 2)]
    assert found(checks.unique("id", "n"), df) == 1  # (NULL, 7) twice
    assert found(checks.unique("id", "state"), df) == 0


def test_relationships_count_rows(spark, df):
    parent = spark.createDataFrame([(1,)], "key int")
    assert [tuple(r) for r in checks.relationships("id", parent, "key").violations(df).collect()] == [(2, 2)]


@pytest.mark.parametrize(
    ("ranges", "bad"),
    [
        ([(1, 5), (5, 9)], 0),
        ([(1, 4), (5, 9)], 1),
        ([(1, 6), (5, 9)], 1),
        ([(1, 5), (5, 5), (5, 9)], 1),
        ([(1, 5), (5, None)], 0),
        ([(1, None), (5, 9)], 1),
    ],
)
def test_adjacent_ranges(spark, ranges, bad):
    df = spark.createDataFrame([(1, *r) for r in ranges] + [(2, 3, 4)], "k int, lo int, hi int")
    assert found(checks.adjacent_ranges("k", "lo", "hi"), df) == bad


def test_summary(df):
    suite = [
        checks.row_count(1, 4, severity="warn"),
        checks.not_null("id"),
        checks.unique("id"),
        checks.between("n", -5, None),
    ]
    rows = {r["check"]: (r["violations"], r["status"]) for r in checks.run_checks(df, suite).collect()}
    assert rows == {
        "row_count(1,4)": (1, "warn"),
        "not_null(id)": (2, "error"),
        "unique(id)": (1, "error"),
        "between(n,-5,None)": (0, "pass"),
    }


def test_missing_days(spark):
    days = [date(2023, 12, 30), date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 3), date(2026, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "full_date date")
    assert sorted(tuple(r) for r in checks.missing_days(df, "full_date").collect()) == [
        (date(2024, 1, 1), date(2024, 1, 3)),
        (date(2024, 1, 3), date(2026, 1, 1)),
    ]
    assert checks.missing_days(df.limit(0), "full_date").count() == 0


def test_contract_differences(spark):
    df = spark.createDataFrame([], schemas.MARTS["dim_labels"]).withColumnRenamed("label_color", "hue")
    got = sorted(tuple(r) for r in checks.contract(df, schemas.MARTS["dim_labels"]).collect())
    assert got == [("hue", None, "string"), ("label_color", "string", None)]


def test_freshness(spark):
    def loaded(*moments):
        return spark.createDataFrame([(m,) for m in moments], "_loaded_at timestamp")

    tables = {
        "new": loaded(datetime(2024, 1, 1), datetime(2024, 1, 9, 20)),
        "late": loaded(datetime(2024, 1, 9, 11, 59)),
        "old": loaded(datetime(2024, 1, 1)),
        "empty": loaded(),
    }
    rows = checks.freshness(tables, datetime(2024, 1, 10), 12, 24).collect()
    assert {r["table"]: r["status"] for r in rows} == {
        "new": "pass",
        "late": "warn",
        "old": "error",
        "empty": "error",
    }


def test_downloads_may_be_older(spark):
    from osspulse.quality.suites import source_freshness

    raw = {name: spark.createDataFrame([(datetime(2024, 1, 1),)], "_loaded_at timestamp") for name in ("commits", "downloads")}
    rows = source_freshness(raw, datetime(2024, 1, 2, 6)).collect()
    assert {r["table"]: r["status"] for r in rows} == {"commits": "error", "downloads": "warn"}
