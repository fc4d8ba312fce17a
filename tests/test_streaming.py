from __future__ import annotations

from datetime import date, datetime

import pytest
from landing import REPO, commit, records, write_landing

from osspulse.sinks import Layer
from osspulse.sources import fresh_table
from osspulse.streaming import start_history, start_load


@pytest.fixture
def clean(spark):
    def drop():
        for layer in Layer:
            spark.sql(f"DROP DATABASE IF EXISTS {layer.value} CASCADE")

    drop()
    yield
    drop()


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_each_file_is_loaded_once(spark, tmp_path, clean):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    first = records()
    write_landing(landing, first)
    run(start_load(spark, landing, "issues", checkpoint))
    assert fresh_table(spark, "raw.issues").count() == 2

    later = records()["issues"][:1]
    later[0].update(state="open", closed_at=None, updated_at="2025-03-04T00:00:00Z")
    write_landing(landing, {"issues": later}, "tidewater/new", date(2025, 3, 5))
    write_landing(landing, {"commits": [commit("x", "y", "2024-01-01T00:00:00Z")]})
    run(start_load(spark, landing, "issues", checkpoint))
    rows = {(r["_repo"], r["number"]): r for r in fresh_table(spark, "raw.issues").collect()}
    assert set(rows) == {(REPO, 7), (REPO, 8), ("tidewater/new", 7)}
    assert rows[(REPO, 7)]["_loaded_at"] == datetime(2025, 3, 3)
    assert rows[("tidewater/new", 7)]["_loaded_at"] == datetime(2025, 3, 5)


def test_newest_record_of_a_batch_wins(spark, tmp_path, clean):
    landing = str(tmp_path / "landing")
    both = records()["issues"][:1] + records()["issues"][:1]
    both[0].update(comments=9, updated_at="2025-03-09T00:00:00Z")
    write_landing(landing, {"issues": both})
    run(start_load(spark, landing, "issues", str(tmp_path / "c")))
    assert [row["comments"] for row in fresh_table(spark, "raw.issues").collect()] == [9]


def test_history_over_batches(spark, tmp_path, clean):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    repository = records()["repositories"][0]
    write_landing(landing, {"repositories": [repository]})
    run(start_history(spark, landing, checkpoint, clock=lambda: datetime(2024, 1, 10)))
    repository.update(language="Rust", updated_at="2025-03-04T00:00:00Z")
    write_landing(landing, {"repositories": [repository]}, "tidewater/moved")
    run(start_history(spark, landing, checkpoint, clock=lambda: datetime(2024, 1, 11)))
    rows = fresh_table(spark, "snapshots.snap_repositories").orderBy("dbt_valid_from").collect()
    assert [(r["language"], r["dbt_valid_from"], r["dbt_valid_to"]) for r in rows] == [
        ("Go", datetime(2024, 1, 10), datetime(2024, 1, 11)),
        ("Rust", datetime(2024, 1, 11), None),
    ]
