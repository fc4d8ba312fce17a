"""Every operator on null, empty, repeated and very long texts, an empty table, and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from osspulse.llm import chat, decontaminate, langid, licenses, packing, quality, sentence_spans, sharding, simhash, warc
from osspulse.llm.common import renamed

LONG = "Word by word the long text goes on and on. " * 20000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, items string, shard string, fingerprint string, score string, removed_spans string, kept string, sequence_id string, hit_spans string"
ROWS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \n\t ", None),
    (None, "a text without an id", "de"),
    (5, LONG, "en"),
    (6, "the same row", "en"),
    (6, "the same row", "en"),
    (7, "$$$ 123 ...", None),
    (8, "Straße ñandú 中文 <|im_end|>", "de"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, None, None, *["x"] * 9) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, None), (2, ""), (3, "on and on"), (3, "on and on"), (None, "the same row")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(5, 1), (6, 0), (6, 1), (2, 0), (None, 1), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int")


def operators(bench, labels):
    return {
        "decontaminate": lambda d: decontaminate.find_contamination(d, bench),
        "sentence_spans": sentence_spans.remove_repeats,
        "packing": lambda d: packing.pack(packing.token_pieces(d)),
        "licenses": licenses.scan_licenses,
        "quality": lambda d: quality.rate(d, quality.train(d, labels)),
        "sharding": lambda d: sharding.shuffle_into_shards(d, 4),
        "simhash": simhash.near_groups,
        "langid": langid.identify,
    }


NAMES = sorted(operators(None, None))


@pytest.mark.parametrize("name", NAMES)
def test_no_row_is_lost(docs, bench, labels, name):
    out = operators(bench, labels)[name](docs)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    found = out.collect()
    if name == "packing":
        found = [r for r in found if r.piece == 0]
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, bench, labels, name):
    assert operators(bench, labels)[name](docs.limit(0)).collect() == []


def test_defined_results(docs, bench, labels):
    hits = {str(r.doc_id): r for r in operators(bench, labels)["decontaminate"](docs).collect()}
    assert (hits["1"].n_words, hits["2"].n_words, hits["1"]["items"]) == (0, 0, [])
    assert hits["5"]["items"] == ["3"] and hits["5"].n_hit == 3 * 20000
    # A test item without an id hits words, but has no name to list.
    assert (hits["6"].n_hit, hits["6"]["items"]) == (3, [])

    spoken = {str(r.doc_id): r for r in langid.identify(docs).collect()}
    assert all(spoken[i].lang_pred == "und" and spoken[i].score == 0 for i in "1237")
    assert not spoken["None"].held_out

    cut = {str(r.doc_id): r for r in sentence_spans.remove_repeats(docs).collect()}
    assert cut["1"].text is None and cut["2"].text == "" and cut["3"].text == " \n\t "
    assert cut["6"].text == "the same row" and cut["6"].n_removed == 0
    assert 0 < len(cut["5"].text) < 2000

    near = {str(r.doc_id): r for r in simhash.near_groups(docs).collect()}
    assert near["1"].fingerprint == near["2"].fingerprint == near["3"].fingerprint == 0
    assert near["3"].component_id == 1 and near["6"].component_id == 6 and near["None"].component_id is None

    rated = {str(r.doc_id): r for r in quality.rate(docs, None).collect()}
    assert rated["1"].n_words == 0 and not rated["1"].kept and rated["1"].quality_score is None
    assert rated["5"].base_failed


def test_stage_helpers_keep_columns(docs, bench):
    for out in (decontaminate.remove_contaminated(docs, bench), simhash.keep_one(docs)):
        assert out.columns == docs.columns
        assert {r.shard for r in out.collect()} == {"x"}
    assert simhash.keep_one(docs).filter("doc_id = 6").count() == 1
    assert simhash.keep_one(docs).filter("doc_id is null").count() == 1
    plain, names, back = renamed(docs)
    assert plain.select(back).columns == docs.columns and names["text"] in plain.columns


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, part string"
    rows = [
        (None, None, None, None, "x"),
        (1, 1, "assistant", None, "x"),
        (1, None, "user\nx<|", "<\\\\|a<|b|>", "x"),
        (1, 2, "assistant", "é中", "x"),
        (1, 2, "assistant", "é中", "x"),
        (2, 0, "assistant", LONG, "x"),
    ]
    turns = spark.createDataFrame(rows, schema)
    made = chat.format_conversations(turns)
    texts = {}
    for r in sorted(made.collect(), key=lambda r: r.part):
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.formatted
    assert chat.parse(texts[1]) == [
        ("user\nx<|", "<\\\\|a<|b|>"),
        ("assistant", ""),
        ("assistant", "é中"),
        ("assistant", "é中"),
    ]
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert (back[None].n_turns, back[1].n_turns, back[1].loss_chars, back[2].loss_chars) == (1, 4, 4, len(LONG))
    assert chat.read_back(chat.format_conversations(turns.limit(0))).collect() == []


def test_parts_of_a_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(900)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(turns, partitions=5)
    assert made.count() >= 5
    (one,) = chat.read_back(made).collect()
    assert (one.n_turns, one.loss_chars) == (900, sum(len(r[3]) for r in rows if r[2] == "assistant"))


def test_pages(spark):
    schema = "page_id long, url string, html string, warc string, block string"
    rows = [(1, None, None, "x", "x"), (None, "http://a/", "<p>a&amp;b<p>c", "x", "x"), (3, "", LONG, "x", "x"), (3, "", LONG, "x", "x")]
    pages = spark.createDataFrame(rows, schema)
    made = warc.derivatives(warc.responses(pages)).collect()
    assert len(made) == 8
    texts = {r.page_id: bytes(r.block).decode() for r in made if r.record_type == "conversion"}
    assert texts[1] == "" and texts[None] == "a&b\nc" and texts[3] == LONG.strip()
    assert warc.derivatives(warc.responses(pages.limit(0))).collect() == []


def test_other_records_are_left_out(spark):
    source = warc.responses(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"))
    assert warc.derivatives(source.withColumn("record_type", F.lit("request"))).count() == 0


def test_batches_are_sliced_by_bytes():
    import pyarrow as pa

    from osspulse.llm.common import sliced

    texts = ["a" * 50, None, "", "b" * 500, "c" * 60, "d" * 30]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    parts = list(sliced(batch, 1, 100))
    assert [len(p) for p in parts] == [3, 1, 2]
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts
    assert [len(p) for p in sliced(batch, 1, 10_000)] == [6] and list(sliced(batch.slice(0, 0), 1, 5)) == []
