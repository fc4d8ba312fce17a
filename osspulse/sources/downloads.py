"""Package download log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse import schemas

# Installers that bulk-mirror the index and are left out of download counts.
MIRROR_INSTALLERS: tuple[str, ...] = ("bandersnatch", "z3c.pypimirror", "Artifactory", "devpi")


def read_download_log(spark: SparkSession, path: str) -> DataFrame:
    """Download events as Parquet, partitioned by the UTC day column `dt`."""
    return spark.read.schema(schemas.DOWNLOAD_LOG).parquet(path)


def daily_downloads(
    log: DataFrame,
    days: date | Sequence[date] | None,
    packages: Sequence[str] | DataFrame | None,
    mirrors: Sequence[str] = MIRROR_INSTALLERS,
    *,
    package: Column | None = None,
    installer: Column | None = None,
    day: Column | None = None,
) -> DataFrame:
    """Downloads per package and day: `_package`, `date` (ISO text), `downloads`.

    `days` is compared with the partition column itself, so the scan prunes to those days;
    None counts every day in the log. An installer that was not reported is not a mirror. A
    package without downloads on a day has no row. `packages` is a list, a one-column frame
    (for lists too long for a predicate), or None for every package.
    """
    package = F.col("file.project") if package is None else package
    installer = F.col("details.installer.name") if installer is None else installer
    day = F.col("dt") if day is None else day

    rows = log
    if days is not None:
        rows = rows.filter(day.isin([days] if isinstance(days, date) else list(days)))
    if packages is not None and not isinstance(packages, DataFrame):
        rows = rows.filter(package.isin(list(packages)))
    rows = rows.filter(~F.coalesce(installer, F.lit("")).isin(list(mirrors)))
    counts = rows.groupBy(package.alias("_package"), day.alias("day")).agg(
        F.count("*").alias("downloads")
    )
    if isinstance(packages, DataFrame):
        # After the count: the join then sees one row per package and day.
        counts = counts.join(packages.toDF("_package"), "_package", "left_semi")
    return counts.select("_package", F.date_format("day", "yyyy-MM-dd").alias("date"), "downloads")
