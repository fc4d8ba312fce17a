"""Landed API responses.

Layout: `<root>/<endpoint>/load_day=<yyyy-mm-dd>/repo_owner=<owner>/repo_name=<name>/*.json`: JSON lines,
the splittable form, or with `multi_line=True` one response page (a JSON array or object) per file.
The day a record landed and the repository it belongs to are taken from the directories, so a load of
some days and repositories reads their directories only.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse import schemas
from osspulse.functions import utc_literal

DIRECTORIES = schemas.record(load_day=schemas.DATE, repo_owner=schemas.STRING, repo_name=schemas.STRING)
# Which file a record came from, in the order of landing; it settles equal versions and is not stored.
PAGE = "_page"


def landing_path(root: str, endpoint: str, repo: str, load_day: date) -> str:
    """Directory for what landed of one endpoint of `owner/name` on one day."""
    owner, name = repo.split("/")
    return os.path.join(root, endpoint, f"load_day={load_day}", f"repo_owner={owner}", f"repo_name={name}")


def stamp(df: DataFrame, load_ts: datetime | Column, **constants: str | Column) -> DataFrame:
    """Add `_loaded_at` and constant columns; they win over record fields of the same name."""
    loaded = load_ts if isinstance(load_ts, Column) else utc_literal(load_ts)
    columns: dict[str, Column] = {"_loaded_at": loaded}
    columns.update({name: F.lit(value) for name, value in constants.items()})
    return df.withColumns(columns)


def _read(reader, root: str, endpoint: str, multi_line: bool) -> DataFrame:
    record = schemas.ENDPOINTS[endpoint]
    rows = (
        reader.schema(T.StructType(record.fields + DIRECTORIES.fields))
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .json(os.path.join(root, endpoint))
    )
    modified = F.unix_micros("_metadata.file_modification_time")
    return rows.withColumn(PAGE, F.struct(modified.alias("at"), F.col("_metadata.file_name").alias("file")))


def attributed(rows: DataFrame, endpoint: str) -> DataFrame:
    """Landed records with the repository and the landing day of their directory, and their page."""
    repo = F.concat_ws("/", "repo_owner", "repo_name")
    stamped = stamp(rows, F.col("load_day").cast("timestamp"), _repo=repo)
    return stamped.select(*schemas.RAW[endpoint].fieldNames(), PAGE)


def read_endpoint(
    spark: SparkSession,
    root: str,
    endpoint: str,
    first_day: date | None = None,
    last_day: date | None = None,
    repos: Sequence[str] | DataFrame | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Records of one endpoint, with `_repo`, `_loaded_at` (the landing day) and `_page`.

    The days and `repos` (`owner/name`s: a list, or a one-column frame for many) limit the load by
    directory. A record that does not fit the schema fails the read.
    """
    rows = _read(spark.read, root, endpoint, multi_line)
    if first_day is not None:
        rows = rows.filter(F.col("load_day") >= F.lit(first_day))
    if last_day is not None:
        rows = rows.filter(F.col("load_day") <= F.lit(last_day))
    if isinstance(repos, DataFrame):
        parts = F.split(repos.columns[0], "/")
        names = repos.select(parts[0].alias("repo_owner"), parts[1].alias("repo_name"))
        rows = rows.join(names, ["repo_owner", "repo_name"], "left_semi")
    elif repos is not None:
        owned: dict[str, list[str]] = {}
        for repo in repos:
            owner, name = repo.split("/")
            owned.setdefault(owner, []).append(name)
        wanted = F.lit(False)
        for owner, names in owned.items():
            wanted = wanted | ((F.col("repo_owner") == owner) & F.col("repo_name").isin(names))
        rows = rows.filter(wanted)
    return attributed(rows, endpoint)


def stream_endpoint(
    spark: SparkSession, root: str, endpoint: str, multi_line: bool = False, **options: str
) -> DataFrame:
    """Landed records as a stream: each file is delivered once. Pass batches to `attributed`."""
    return _read(spark.readStream.options(**options), root, endpoint, multi_line)


def read_repositories(spark: SparkSession, root: str, **options) -> DataFrame:
    return read_endpoint(spark, root, "repositories", **options)


def read_commits(spark: SparkSession, root: str, **options) -> DataFrame:
    return read_endpoint(spark, root, "commits", **options)


def read_issues(spark: SparkSession, root: str, **options) -> DataFrame:
    """Issues, pull requests among them: those carry `pull_request.url`."""
    return read_endpoint(spark, root, "issues", **options)


def read_pull_requests(spark: SparkSession, root: str, **options) -> DataFrame:
    return read_endpoint(spark, root, "pull_requests", **options)


def read_releases(spark: SparkSession, root: str, **options) -> DataFrame:
    return read_endpoint(spark, root, "releases", **options)
