"""Invented landed records of two repositories, written in the landing layout."""

from __future__ import annotations

import json
import os
from copy import deepcopy
from datetime import date

from osspulse.sources import landing_path

REPO, OTHER = "tidewater/lantern", "tidewater/mooring"
LANDED = date(2025, 3, 3)


def _user(login, number=1):
    return {"login": login, "id": number} if login else None


REPOSITORY = {
    "id": 4107,
    "name": "lantern",
    "full_name": REPO,
    "owner": _user("tidewater", 88),
    "description": "Signals for small harbours",
    "stargazers_count": 412,
    "forks_count": 36,
    "open_issues_count": 9,
    "language": "Go",
    "license": {"key": "apache-2.0", "spdx_id": "Apache-2.0"},
    "topics": ["signals", "harbour", "Night-light"],
    "created_at": "2019-05-04T06:30:00Z",
    "updated_at": "2025-02-27T18:00:00Z",
}
SECOND = {**REPOSITORY, "id": 4230, "name": "mooring", "full_name": OTHER, "topics": [], "license": None, "stargazers_count": 17}


def commit(sha, login, day, parents=1, message="trim the wick"):
    return {
        "sha": sha,
        "commit": {
            "author": {"name": (login or "nobody").title(), "email": f"{sha}@tidewater.test", "date": day},
            "message": message,
        },
        "author": _user(login),
        "parents": [{"sha": f"{sha}-{i}", "url": "u"} for i in range(parents)],
    }


def label(name, color):
    return {"id": 1, "name": name, "color": color}


RECORDS = {
    "repositories": [REPOSITORY],
    "commits": [
        commit("lamp-1", "mira", "2025-02-24T08:15:00Z"),
        commit("lamp-2", "otto", "2025-02-25T21:40:00Z"),
        commit("lamp-3", "mira", "2025-02-26T05:05:00Z", parents=0),
    ],
    "issues": [
        {
            "number": 7,
            "title": "The flame flickers at low tide",
            "state": "closed",
            "user": _user("pilar"),
            "created_at": "2025-02-20T09:30:00Z",
            "updated_at": "2025-02-22T12:10:00Z",
            "closed_at": "2025-02-22T12:10:00Z",
            "comments": 3,
            "labels": [label("weather", "3355aa"), label("urgent", "aa3300")],
        },
        {
            "number": 8,
            "title": "A change in the shape of an issue",
            "state": "open",
            "user": _user("quinn"),
            "created_at": "2025-02-21T10:00:00Z",
            "updated_at": "2025-02-21T10:00:00Z",
            "closed_at": None,
            "comments": 0,
            "labels": [],
            "pull_request": {"url": "https://tidewater.test/pulls/8"},
        },
    ],
    "pull_requests": [
        {
            "number": 8,
            "title": "Brighter glass",
            "state": "closed",
            "user": _user("quinn"),
            "created_at": "2025-02-21T10:00:00Z",
            "updated_at": "2025-02-23T13:20:00Z",
            "merged_at": "2025-02-23T13:20:00Z",
            "labels": [label("optics", "22cc88")],
        },
        {
            "number": 9,
            "title": "Oil gauge",
            "state": "open",
            "user": _user("mira"),
            "created_at": "2025-02-26T16:45:00Z",
            "updated_at": "2025-02-26T16:45:00Z",
            "merged_at": None,
            "labels": [],
        },
    ],
    "releases": [
        {"id": 51, "tag_name": "spring", "name": "Spring tide", "published_at": "2025-02-18T07:00:00Z"},
        {"id": 50, "tag_name": "neap", "name": None, "published_at": "2025-01-29T07:00:00Z"},
    ],
}


def records():
    return deepcopy(RECORDS)


def write_landing(root, by_endpoint, repo=REPO, load_day=LANDED, page=1, multi_line=False):
    """One file per endpoint: JSON lines, or a response page."""
    for endpoint, rows in by_endpoint.items():
        folder = landing_path(str(root), endpoint, repo, load_day)
        os.makedirs(folder, exist_ok=True)
        text = json.dumps(rows) if multi_line else "".join(json.dumps(row) + "\n" for row in rows)
        with open(os.path.join(folder, f"page-{page}.json"), "w", encoding="utf-8") as file:
            file.write(text)


def write_projects(path, rows=((REPO, "lantern"),)):
    with open(path, "w", encoding="utf-8") as file:
        file.write("repo,package\n" + "".join(f"{repo},{package}\n" for repo, package in rows))
    return str(path)
