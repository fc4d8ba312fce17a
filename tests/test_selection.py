"""Exact medians by rounds of histograms against a plain median of all elements."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from osspulse.operators.selection import exact_median

LEAST, MOST = -(2**63), 2**63 - 1


def expected(rows):
    groups = {}
    for *key, value, count in rows:
        elements = groups.setdefault(tuple(key), [])
        if value is not None and count is not None and count > 0:
            elements += [value] * count
    middle = {}
    for key, elements in groups.items():
        elements.sort()
        n = len(elements)
        middle[key] = elements[(n - 1) // 2] / 2 + elements[n // 2] / 2 if n else None
    return middle


def medians(df, keys, **options):
    return {tuple(r[:-1]): r[-1] for r in exact_median(df, keys, "v", "n", **options).collect()}


@pytest.mark.parametrize(("seed", "bins", "reach"), [(1, 2, 60), (2, 7, 5_000), (3, 64, 10**15)])
def test_groups_of_many_sizes(spark, seed, bins, reach):
    rng = random.Random(seed)
    rows = []
    for group in [None, *range(12)]:
        for _ in range(rng.choice([1, 2, 3, 40, 200])):
            rows.append((group, rng.choice("xy"), rng.randint(-reach, reach), rng.choice([1, 1, 2, 9])))
    rows += [(0, "x", None, 5), (1, "x", 3, None), (2, "x", 3, 0), (2, "y", 3, -4), (50, "x", None, 1), (51, "x", 8, 0)]
    df = spark.createDataFrame(rows, "g int, h string, v bigint, n bigint").repartition(5)
    assert medians(df, ["g", "h"], bins=bins, salts=2) == expected(rows)


def test_ends_of_the_range(spark):
    rows = [(1, LEAST, 1), (1, MOST, 1), (2, LEAST, 1), (2, LEAST + 1, 1), (2, MOST, 1), (3, MOST - 1, 2), (3, MOST, 2)]
    rows += [(4, LEAST, 5), (4, 0, 1), (4, 1, 1), (4, MOST, 5), (5, -1, 1), (5, 0, 1), (6, LEAST, 3), (6, LEAST + 2, 4), (6, MOST, 1)]
    df = spark.createDataFrame(rows, "g int, v bigint, n bigint")
    want = expected(rows)
    assert medians(df, ["g"], bins=16, salts=2) == want
    assert medians(df, ["g"], bins=2, salts=1) == want


def test_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(4, 1), (9, 1), (1, 1)], "v int, n int")
    assert medians(df, [], salts=2) == {(): 4.0}
    assert medians(df.limit(0), []) == {(): None}
    empty = spark.createDataFrame([], "g int, v bigint, n bigint")
    assert medians(empty, ["g"]) == {}


def test_refused_arguments(spark):
    df = spark.createDataFrame([(1.5, 1)], "v double, n int")
    with pytest.raises(TypeError):
        exact_median(df, [], "v", "n")
    with pytest.raises(ValueError):
        exact_median(df.select(F.lit(1).alias("v"), "n"), [], "v", "n", bins=1)


def test_a_group_of_many_distinct_values(spark):
    """A million distinct values in one group beside small ones; the rounds keep to their bins."""
    n = 1_000_000
    spread = F.pmod(F.col("id") * 7_919, F.lit(n)) * 1_000_003 - 17
    df = spark.range(n).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50).alias("g"), spread.alias("v"), F.lit(1).alias("n"))
    found = exact_median(df, ["g"], "v", "n", bins=32)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan and "Python" not in plan
    got = {r.g: r["median"] for r in found.collect()}
    values = {}
    for i in range(n):
        values.setdefault(0 if i % 3 < 2 else i % 50, []).append(i * 7_919 % n * 1_000_003 - 17)
    assert got == {g: statistics.median(v) for g, v in values.items()}
