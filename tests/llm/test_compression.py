"""The compression classifier: held-out labels, calibration, and what it never looks at."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from osspulse.llm import compression
from osspulse.llm.queries import op12_compression_quality


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in op12_compression_quality(spark, sf_dir).collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == is_held_out(i) and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    for label in (0, 1):
        right = [rows[i].predicted == label for i in rows if rows[i].held_out and labels.get(i) == label]
        assert len(right) > 100 and np.mean(right) > 0.95
    held = [i for i in rows if rows[i].held_out and i in labels]
    # Calibrated: among held-out rows the mean score is the share of class 1.
    assert abs(np.mean([rows[i].score for i in held]) - np.mean([labels[i] for i in held])) < 0.05


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice(("river", "mountain", "valley", "forest", "meadow")) for _ in range(80))
    bad = lambda: " ".join(rng.choice(("$$buy", "now!!", "click>>", "win##", "free%%")) for _ in range(80))
    rows = [(i, bad() if i % 4 == 0 else good(), int(i % 4 != 0)) for i in range(400)]
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")


def test_held_out_labels_teach_nothing(spark, corpus):
    docs, labels = frames(spark, corpus)
    wrong = labels.withColumn("quality", F.when(compression.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r.doc_id: r.score for r in compression.classify(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in compression.classify(docs, wrong).collect()}
    assert all((first[i] >= 0.5) == bool(label) for i, _, label in corpus)


def test_score_depends_on_the_text_alone(spark, corpus):
    docs, labels = frames(spark, corpus)
    model = compression.train(docs, labels)
    again = docs.withColumn("text", F.lit(corpus[1][1]))
    assert len({r.score for r in compression.rate(again, model).collect()}) == 1


def test_defined_results(spark, corpus):
    docs, labels = frames(spark, corpus)
    more = [(None, corpus[1][1]), (1000, None), (1001, ""), (1002, "x"), (1003, corpus[1][1] * 2000), (1, corpus[1][1])]
    schema = "doc_id long, text string, score string, predicted string, held_out int, other string"
    odd = spark.createDataFrame([(*r, "s", "p", 1, "o") for r in more], schema)
    both = docs.unionByName(odd, allowMissingColumns=True)
    odd_labels = labels.union(spark.createDataFrame([(None, 1), (1, 1), (2, None)], labels.schema))
    rows = compression.classify(both, odd_labels).filter("other = 'o'").collect()
    assert len(rows) == len(more)
    by = {(r.doc_id, r.text): r for r in rows}
    assert by[None, corpus[1][1]].held_out is False and by[None, corpus[1][1]].predicted == 1
    assert by[1000, None].score == by[1001, ""].score and 0 <= by[1001, ""].score <= 1
    assert by[1003, corpus[1][1] * 2000].predicted == 1


def test_no_labels_one_class_and_an_empty_table(spark, corpus):
    docs, labels = frames(spark, corpus)
    assert {r.score for r in compression.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in compression.classify(docs, labels.filter("quality = 1")).collect()} == {1.0}
    assert compression.classify(docs.limit(0), labels).collect() == []


def test_sample_has_its_bounds_and_every_class(spark, corpus):
    from osspulse.llm.common import bounded_sample

    rows = [(i, "x" * 5000 + str(i), int(i != 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind int")
    found, counts = bounded_sample(df, "kind", "doc_id", "text", 20, 8000)
    assert counts == {0: 1, 1: 99}
    assert sorted(r[0] for r in found) == [0, 1, 1]
    found, _ = bounded_sample(df, "kind", "doc_id", "text", 7, 1 << 30)
    assert sorted(r[0] for r in found) == [0] + [1] * 7
    assert max(len(r[2]) for r in bounded_sample(df, "kind", "doc_id", "text", 7, 100)[0]) == 100


def test_calibration_rises_and_keeps_the_mean():
    rng = np.random.default_rng(1)
    x = rng.normal(size=3000).round(2)
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x))).astype(float)
    at, chance = compression.calibrate(x, y, np.ones(3000))
    assert (np.diff(at) >= 0).all() and (np.diff(chance) >= 0).all() and chance[0] > 0 and chance[-1] < 1
    assert abs(np.interp(x, at, chance).mean() - y.mean()) < 0.01
    assert abs(np.interp(0.5, at, chance) - 1 / (1 + np.exp(-1))) < 0.1


def test_difference_is_that_of_the_sizes():
    import zstandard

    both = (b"bad worse worst " * 20, b"good better best " * 20)
    model = compression.Model(both, np.zeros(1), np.zeros(1), block=64)
    texts = ["good better best " * 10, "", None, "worse"]
    for text, got in zip(texts, model.sizes(pa.array(texts)).tolist(), strict=True):
        raw, want = (text or "").encode(), []
        for d in both:
            c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
            want.append(sum(len(c.compress(raw[i : i + 64])) for i in range(0, len(raw), 64)))
        assert got == want
