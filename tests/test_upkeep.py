"""Marts kept up from signed changes against marts rebuilt from all raw rows; locality, stops in between, the key index."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from osspulse import schemas, upkeep
from osspulse.operators import deltas
from osspulse.pipeline import build_marts, load_raw
from osspulse.sinks import KeyIndex, Layer, WriteGroup, catalog_marts, ensure_layers, finish_switches, merge_table, tables
from osspulse.sources import PAGE, fresh_table

KEPT_UP = (
    "dim_contributors", "dim_labels", "dim_repositories", "fct_pull_requests", "fct_issues", "bridge_issue_labels",
    "fct_contributor_activity_monthly",
)
REPOS = ("sea/one", "sea/two", "sea/three")
LOGINS = ("ada", "ben", "cleo", "dan", None)


def drop_layers(spark):
    for layer in Layer:
        spark.sql(f"DROP DATABASE IF EXISTS {layer.value} CASCADE")


@pytest.fixture
def layers(spark, monkeypatch):
    # Few buckets, as each is a partition to write and to switch.
    monkeypatch.setattr(upkeep, "PERSON_BUCKETS", 4)
    monkeypatch.setattr(tables, "INDEX_BUCKETS", 4)
    drop_layers(spark)
    ensure_layers(spark)
    yield
    drop_layers(spark)


class World:
    """Random records and what a day changes in them."""

    def __init__(self, seed):
        self.rng = random.Random(seed)
        self.now = datetime(2025, 3, 1, 6)
        self.repos = {}
        self.issues, self.pulls, self.commits = {}, {}, {}

    def moment(self, back=40):
        return self.now - timedelta(hours=self.rng.randint(0, 24 * back))

    def labels(self):
        return [(i, name, self.rng.choice(("red", "blue"))) for i, name in enumerate(self.rng.sample(("a", "b", "c", "d"), self.rng.randint(0, 3)))]

    def day(self, repos=REPOS, new=3, changed=3):
        self.now += timedelta(days=1)
        pick = self.rng.choice
        out = {"repositories": [], "issues": [], "pull_requests": [], "commits": []}
        for repo in repos:
            if repo not in self.repos or self.rng.random() < 0.4:
                self.repos[repo] = pick(("Go", "Rust", None))
            number = REPOS.index(repo)
            out["repositories"].append(
                (number, repo.split("/")[1], repo, ("sea", 1), "text", 1, 1, 1, self.repos[repo], None, None, datetime(2020, 1, 1), self.now, repo, self.now)
            )
            for kind, known in (("issues", self.issues), ("pull_requests", self.pulls)):
                mine = [k for k in known if k[0] == repo]
                fresh = [(repo, len(mine) + i) for i in range(new)]
                for key in fresh + self.rng.sample(mine, min(changed, len(mine))):
                    created = known.get(key, self.moment())
                    known[key] = created
                    done = pick((None, created + timedelta(hours=self.rng.randint(0, 300))))
                    user = pick(LOGINS)
                    row = [key[1], "t", "closed" if done else "open", (user, 1) if user else None, created, self.now, done]
                    if kind == "issues":
                        row += [self.rng.randint(0, 9), self.labels(), ("u",) if self.rng.random() < 0.2 else None]
                    else:
                        row += [self.labels()]
                    out[kind].append((*row, repo, self.now))
            for _ in range(new):
                sha = f"{repo}{len(self.commits)}"
                self.commits[sha] = repo
                user = pick(LOGINS)
                author = ((user or "x", "e", self.moment()), "m")
                parents = [("p", "u")] * pick((0, 1, 1, 2))
                out["commits"].append((sha, author, (user, 1) if user else None, parents, repo, self.now))
        return out


def load(spark, day):
    for endpoint, rows in day.items():
        schema = schemas.RAW[endpoint]
        df = spark.createDataFrame(rows, schema).withColumn(PAGE, F.lit("p"))
        load_raw(spark, endpoint, df)


def marts(spark, now, **options):
    projects = spark.createDataFrame([], schemas.PROJECTS)
    build_marts(spark, projects, now, **options)
    return {name: content(spark, name) for name in KEPT_UP}


def content(spark, name):
    rows = fresh_table(spark, Layer.MARTS.table(name)).select(schemas.MARTS[name].fieldNames()).collect()
    return Counter(tuple(row) for row in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories(spark, layers, seed):
    world = World(seed)
    for number in range(2):
        load(spark, world.day())
        if seed == 2 and number == 1:
            # Two days of changes for one round of upkeep.
            load(spark, world.day())
        kept = marts(spark, world.now)
    assert not any(upkeep.pending_batches(spark).values())
    assert kept == marts(spark, world.now, full_refresh=True)
    assert all(kept[name] for name in KEPT_UP)


def folders(spark, name):
    partitions = [row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    specs = {p: "PARTITION ({}='{}')".format(*p.split("=")) for p in partitions}
    return {p: tables._location(spark, name, spec) for p, spec in specs.items()}


def test_a_day_rewrites_only_what_it_touches(spark, layers):
    world = World(3)
    load(spark, world.day(new=6))
    marts(spark, world.now)
    by_person = [Layer.MARTS.table(x) for x in ("dim_contributors", "fct_contributor_activity_monthly")] + [upkeep.EVENTS]
    stored = [*by_person, Layer.MARTS.table("fct_pull_requests"), Layer.MARTS.table("fct_issues"), Layer.MARTS.table("bridge_issue_labels")]
    before = {name: folders(spark, name) for name in stored}
    created = datetime(2025, 1, 15)
    row = (999, "t", "open", ("zoe", 1), created, world.now, None, [], "sea/one", world.now + timedelta(hours=1))
    load(spark, {"pull_requests": [row]})
    kept = marts(spark, world.now)
    after = {name: folders(spark, name) for name in stored}
    bucket = spark.createDataFrame([("zoe",)], "username string").select(upkeep.person_bucket()).first()[0]
    for name in by_person:
        changed = {p for p in after[name] if after[name][p] != before[name].get(p)}
        assert changed == {f"_bucket={bucket}"}, name
    pulls = Layer.MARTS.table("fct_pull_requests")
    assert {p for p in after[pulls] if after[pulls][p] != before[pulls].get(p)} == {"opened_date_key=20250115"}
    for name in stored[-2:]:
        assert after[name] == before[name]
    assert kept == marts(spark, world.now, full_refresh=True)


@pytest.mark.parametrize("point", ["journal", "last switch"])
def test_stops_in_between(spark, layers, monkeypatch, point):
    world = World(4)
    load(spark, world.day())
    marts(spark, world.now)
    load(spark, world.day())
    group = WriteGroup.commit
    switch, calls = tables._switch_partitions, []

    class Stop(Exception):
        pass

    def stop_at(*arguments):
        calls.append(arguments)
        if len(calls) == 5:
            raise Stop
        return switch(*arguments)

    def commit(self):
        if self.journal.rsplit("/", 1)[0].endswith("intermediate.db"):
            if point == "journal":
                raise Stop
            monkeypatch.setattr(tables, "_switch_partitions", stop_at)
        return group(self)

    with monkeypatch.context() as patched:
        patched.setattr(WriteGroup, "commit", commit)
        with pytest.raises(Stop):
            marts(spark, world.now)
    monkeypatch.setattr(tables, "_switch_partitions", switch)
    assert finish_switches(spark, "intermediate") == (point != "journal")
    kept = marts(spark, world.now)
    assert kept == marts(spark, world.now, full_refresh=True)


def test_key_index_reads_the_buckets_of_the_batch(spark, layers, monkeypatch):
    monkeypatch.setattr(tables, "INDEX_BUCKETS", 64)
    name = "raw.things"
    schema = "id long, month string, value string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    first = frame([(i, f"m{i % 5}", "x" * 50) for i in range(3000)])
    merge_table(spark, name, first, ["id"], "month", indexed=True)
    index = KeyIndex(spark, name, ["id"], "month")
    all_files = set(fresh_table(spark, index.name).inputFiles())
    read = index.read(index.hashed(frame([(7, "m9", "y")]).select("id")))
    assert len(all_files) >= 64 and len(set(read.inputFiles())) == 1
    # Bytes: one bucket of the index against the key columns of the table.
    size = lambda files: sum(tables._filesystem(spark, f)[0].getFileStatus(tables._filesystem(spark, f)[1]).getLen() for f in files)
    assert size(read.inputFiles()) * 20 < size(all_files)
    before = folders(spark, name)
    # A key that moves is found and leaves its old partition; others are not touched.
    merge_table(spark, name, frame([(7, "m9", "y"), (5000, "m9", "z")]), ["id"], "month", indexed=True)
    after = folders(spark, name)
    assert {p for p in before if before[p] != after[p]} == {"month=m2"}
    rows = {r.id: (r.month, r.value) for r in fresh_table(spark, name).collect()}
    assert len(rows) == 3001 and rows[7] == ("m9", "y")
    # It moves once more, from where the index now has it.
    merge_table(spark, name, frame([(7, None, "w")]), ["id"], "month", indexed=True)
    merge_table(spark, name, frame([(7, "m1", "v")]), ["id"], "month", indexed=True)
    rows = [tuple(r) for r in fresh_table(spark, name).filter("id = 7").collect()]
    assert rows == [(7, "v", "m1")]
    places = {r[0] for r in fresh_table(spark, index.name).join(index.hashed(frame([(7, "m", "")]).select("id")), ["_k1", "_k2"]).select("_place").collect()}
    assert places == {"m1"}


def test_an_index_is_made_for_a_table_without_one(spark, layers):
    frame = lambda rows: spark.createDataFrame(rows, "id long, month string")
    merge_table(spark, "raw.old", frame([(1, "a"), (2, "b")]), ["id"], "month")
    merge_table(spark, "raw.old", frame([(1, "c")]), ["id"], "month", indexed=True)
    assert sorted(map(tuple, fresh_table(spark, "raw.old").collect())) == [(1, "c"), (2, "b")]


ROWS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 2)), max_size=12)


@given(before=ROWS, after=ROWS)
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_signs_add_up(spark, before, after):
    schema = "k string, v int"
    old, new = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    count = lambda df: df.groupBy("k", "v").agg(F.count("*").alias("n"))
    changes = deltas.signed(old, new)
    got = deltas.add_counts(count(old), deltas.count_changes(changes, ["k", "v"]), ["k", "v"])
    assert {(r.k, r.v): r.n for r in got.collect()} == Counter(after)
    net = Counter()
    for r in deltas.net(changes).collect():
        net[r.k, r.v] = r["_sign"]
    want = Counter(after)
    want.subtract(Counter(before))
    assert net == Counter({k: n for k, n in want.items() if n})


def test_version_changes(spark):
    schema = "repository_key string, repository_name string, valid_from date, valid_to date"
    day = lambda text: datetime.strptime(text, "%Y-%m-%d").date()
    start, end = day("1900-01-01"), day("9999-12-31")
    old = spark.createDataFrame([("a1", "a", start, end), ("b1", "b", start, end), ("d1", "d", start, end)], schema)
    new = spark.createDataFrame(
        [("a1", "a", start, day("2025-03-02")), ("a2", "a", day("2025-03-02"), end), ("b1", "b", start, end), ("c1", "c", start, end)], schema
    )
    found = {r.name: r.since for r in upkeep.version_changes(old, new).collect()}
    assert found == {"a": day("2025-03-02"), "c": start, "d": start}


def test_marts_have_their_contract(spark, layers):
    world = World(5)
    load(spark, world.day())
    marts(spark, world.now)
    for name in KEPT_UP:
        assert catalog_marts(spark)[name].columns == schemas.MARTS[name].fieldNames()
