"""Generated days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spine_between(bounds: DataFrame) -> DataFrame:
    """One `full_date` row per day for one-row `bounds(first_day, end_day)`; the end is exclusive."""
    last_day = F.date_sub("end_day", 1)
    return bounds.filter(F.col("first_day") <= last_day).select(
        F.explode(F.sequence("first_day", last_day)).alias("full_date")
    )


def date_spine(spark: SparkSession, first_day: date, end_day: date) -> DataFrame:
    """Days from `first_day` up to, not including, `end_day`."""
    bounds = spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(end_day).alias("end_day"))
    return spine_between(bounds)
