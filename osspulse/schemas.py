"""Schemas: landed API records, raw tables, mart contracts.

Landed records are read with these schemas instead of inferred ones: a field missing from
every record is a NULL column and a missing list is NULL, so no reader has to guess.
"""

from __future__ import annotations

from pyspark.sql import types as T

BIGINT, INT, STRING, BOOLEAN = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
DATE, TIMESTAMP, TIMESTAMP_NTZ = T.DateType(), T.TimestampType(), T.TimestampNTZType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


USER = record(login=STRING, id=BIGINT)
LABELS = T.ArrayType(record(id=BIGINT, name=STRING, color=STRING))

# ----- landed API records -----
REPOSITORY = record(
    id=BIGINT,
    name=STRING,
    full_name=STRING,
    owner=USER,
    description=STRING,
    stargazers_count=BIGINT,
    forks_count=BIGINT,
    open_issues_count=BIGINT,
    language=STRING,
    license=record(key=STRING, spdx_id=STRING),
    topics=T.ArrayType(STRING),
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)
COMMIT = record(
    sha=STRING,
    commit=record(author=record(name=STRING, email=STRING, date=TIMESTAMP), message=STRING),
    author=USER,
    parents=T.ArrayType(record(sha=STRING, url=STRING)),
)
ISSUE = record(
    number=BIGINT,
    title=STRING,
    state=STRING,
    user=USER,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
    closed_at=TIMESTAMP,
    comments=BIGINT,
    labels=LABELS,
    pull_request=record(url=STRING),
)
PULL_REQUEST = record(
    number=BIGINT,
    title=STRING,
    state=STRING,
    user=USER,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
    merged_at=TIMESTAMP,
    labels=LABELS,
)
RELEASE = record(id=BIGINT, tag_name=STRING, name=STRING, published_at=TIMESTAMP)
DOWNLOAD_LOG = record(
    timestamp=TIMESTAMP,
    file=record(project=STRING),
    details=record(installer=record(name=STRING)),
    dt=DATE,
)
PROJECTS = record(repo=STRING, package=STRING)

ENDPOINTS: dict[str, T.StructType] = {
    "repositories": REPOSITORY,
    "commits": COMMIT,
    "issues": ISSUE,
    "pull_requests": PULL_REQUEST,
    "releases": RELEASE,
}

# ----- raw tables: the landed record plus where it came from and when it was loaded -----
PROVENANCE = record(_repo=STRING, _loaded_at=TIMESTAMP)
RAW_DOWNLOADS = record(_package=STRING, date=STRING, downloads=BIGINT, _loaded_at=TIMESTAMP)
RAW: dict[str, T.StructType] = {
    **{name: T.StructType(schema.fields + PROVENANCE.fields) for name, schema in ENDPOINTS.items()},
    "downloads": RAW_DOWNLOADS,
}

# ----- mart contracts -----
MARTS: dict[str, T.StructType] = {
    "dim_dates": record(
        date_key=INT, full_date=DATE, year=BIGINT, quarter=BIGINT, month=BIGINT, month_name=STRING,
        day_of_month=BIGINT, day_of_week=BIGINT, day_name=STRING, is_weekend=BOOLEAN,
        week_of_year=BIGINT,
    ),
    "dim_contributors": record(
        contributor_key=STRING, username=STRING, first_commit_date=DATE, last_commit_date=DATE,
        total_commits=BIGINT, total_prs_opened=BIGINT, total_prs_merged=BIGINT,
        distinct_projects_count=BIGINT, primary_project=STRING,
    ),
    "dim_repositories": record(
        repository_key=STRING, repository_id=BIGINT, repository_name=STRING, name=STRING,
        owner_login=STRING, description=STRING, language=STRING, license_spdx=STRING, topics=STRING,
        created_at=TIMESTAMP, updated_at=TIMESTAMP, valid_from=DATE, valid_to=DATE, is_current=BOOLEAN,
    ),
    "dim_labels": record(label_key=STRING, label_name=STRING, label_color=STRING),
    "fct_commits": record(
        commit_key=STRING, repository_key=STRING, contributor_key=STRING, date_key=INT,
        commit_hash=STRING, committed_at=TIMESTAMP, _loaded_at=TIMESTAMP,
    ),
    "fct_pull_requests": record(
        pr_key=STRING, repository_key=STRING, author_key=STRING, opened_date_key=INT,
        merged_date_key=INT, is_merged=BOOLEAN, time_to_merge_hours=BIGINT,
    ),
    "fct_issues": record(
        issue_key=STRING, repository_key=STRING, author_key=STRING, opened_date_key=INT,
        closed_date_key=INT, is_closed=BOOLEAN, time_to_close_hours=BIGINT, comment_count=BIGINT,
    ),
    "fct_releases": record(
        release_key=STRING, repository_key=STRING, date_key=INT, tag_name=STRING, release_name=STRING,
        published_at=TIMESTAMP, _loaded_at=TIMESTAMP,
    ),
    "fct_daily_downloads": record(
        download_key=STRING, package=STRING, repository_key=STRING, date_key=INT, download_count=BIGINT,
    ),
    "fct_repository_metrics": record(
        metric_key=STRING, repository_id=BIGINT, repository_name=STRING, repository_key=STRING,
        date_key=INT, stars=BIGINT, forks=BIGINT, open_issues=BIGINT,
    ),
    "fct_contributor_activity_monthly": record(
        activity_key=STRING, contributor_key=STRING, username=STRING, event_month=TIMESTAMP_NTZ,
        month_date_key=INT, commits=BIGINT, prs_opened=BIGINT, prs_merged=BIGINT, issues_opened=BIGINT,
        issues_closed=BIGINT,
    ),
    "bridge_issue_labels": record(issue_key=STRING, label_key=STRING),
}
