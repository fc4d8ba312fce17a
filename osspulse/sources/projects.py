"""The list of tracked projects: `repo` (owner/name) and its `package`, if published."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse import schemas


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; a path that does not exist is an empty list."""
    try:
        return spark.read.schema(schemas.PROJECTS).option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.PROJECTS)


def _filled(projects: DataFrame, column: str) -> DataFrame:
    return projects.select(column).filter(F.col(column).isNotNull() & (F.col(column) != ""))


def target_repos(projects: DataFrame) -> DataFrame:
    return _filled(projects, "repo")


def target_packages(projects: DataFrame) -> DataFrame:
    return _filled(projects, "package")
