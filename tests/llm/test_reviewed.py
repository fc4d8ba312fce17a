"""What earlier reviews found: equal hashes that are no equal bytes, endless white space and markup, small languages."""

from __future__ import annotations

import html
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from osspulse.llm import bytestext, langid, packing, quality, sentence_spans, sharding, warc

OTHER = str.maketrans("ab", "ba")


def regular(n):
    """The word a, b, b, a, ... that a sum of powers cannot tell from its mirror."""
    word = "a"
    while len(word) < n:
        word += word.translate(OTHER)
    return word[:n]


WORD = regular(4096)
MIRROR = WORD.translate(OTHER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def token_ids(texts):
    vocabulary = packing.default_vocabulary()
    ids, first = packing.token_ids(pa.array(texts, pa.string()), vocabulary, 0, packing.added_tokens(vocabulary))
    return [ids[i:j].tolist() for i, j in zip(first, first[1:], strict=False)]


@pytest.mark.parametrize(
    "text",
    [
        f"x {WORD} y {MIRROR}",
        *(f"q{c * 2_000_000}z" for c in (" ", "\t", "\n")),
        " " * 2_000_000,
        "a \n" * 300_000,
        "w" * 500_000 + " x",
        "é" * 30_000 + " <|endoftext|>" + " " * 30_000,
    ],
    ids=lambda text: repr(text[:3]),
)
def test_ids_of_odd_texts(tokenizer, text):
    assert token_ids([text, None, text[:5]]) == [
        tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in (text, None, text[:5])
    ]


def test_pipeline_packs_endless_white_space(spark, sf_dir):
    rows = [(i, f"{' '.join(f'w{i}x{j}' for j in range(60))}{' ' * 1_500_000}end", "en", "s", 1) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.pack(spark, docs, sf_dir).collect()} == {0, 1}


def test_mirrored_lines_and_words_are_no_repeats():
    found = quality.statistics(pa.array([f"{WORD}\n{MIRROR}", f"a b {WORD} a b {MIRROR}", "x\nx\ny y y y"]))
    assert found["n_dup_lines"].tolist() == [0, 0, 1]
    assert found["n_repeat_words"].tolist() == [0, 0, 4]


def test_numbers_stand_for_equal_bytes():
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(500)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    numbers, n = bytestext.numbered(data, ends - [len(w) for w in words], ends)
    assert n == len(set(words)) and len(set(zip(words, numbers.tolist(), strict=True))) == n
    pairs = bytestext.paired(numbers[:-1], numbers[1:])
    assert len(set(pairs.tolist())) == len(set(zip(words, words[1:], strict=False)))


def test_a_language_of_few_long_texts_is_learned(spark):
    rng = random.Random(2)
    words = {"en": "the of and river to mountain", "fr": "le de et riviere la montagne", "de": "der von und fluss zu berg"}
    text = lambda lang, n: " ".join(rng.choice(words[lang].split()) for _ in range(n))
    rows = [(i, text(("en", "fr")[i % 2], 80), ("en", "fr")[i % 2]) for i in range(120)]
    rows += [(1000 + i, text("de", 200_000), "de") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample_bytes=10_000)
    assert model.languages == ["de", "en", "fr"]
    wrong = [r.doc_id for r in langid.identify(docs, sample_bytes=10_000).collect() if r.lang_pred != r.lang]
    assert wrong == []


HIDDEN = ("script", "style", "noscript", "template", "head")


def loop_text(page):
    """What a page shows, by walking over it character by character."""
    page, out, at = re.sub(r"\s+", " ", page), [], 0
    while at < len(page):
        low = page[at:].lower()
        if low.startswith("<!--") and "-->" in low[4:]:
            at += low.index("-->", 4) + 3
            out.append(" ")
            continue
        opened = next((n for n in HIDDEN if re.match(rf"<{n}\b[^<>]*>", low)), None)
        if opened:
            end = re.search(rf"</{opened}\s*>", low[low.index(">") :])
            if end:
                at += low.index(">") + end.end()
                out.append(" ")
                continue
        out.append(page[at])
        at += 1
    shown = re.sub(warc.LINE, "\n", "".join(out))
    shown = html.unescape(re.sub(r"<[!?/]?[a-zA-Z][^<>]*>|<![^<>]*>", "", shown))
    return "\n".join(x for x in (" ".join(line.split()) for line in shown.split("\n")) if x)


def test_plain_text_against_a_loop(spark, sf_dir):
    rng = random.Random(3)
    bits = ["<!--", "-->", "<script>", "</script >", "<style a=1>", "</style>", "<p>", "</p>", "<head>", "</head>", "x", " y ", "&amp;", "<", ">", "<b>", "<script"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    pages += [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect() if r.html]
    for page in pages:
        assert warc.plain_text(page) == loop_text(page), page


def test_links_and_digests_against_a_loop(spark, sf_dir):
    import base64
    import hashlib
    from html.parser import HTMLParser

    class Links(HTMLParser):
        def __init__(self):
            super().__init__()
            self.links = []

        def handle_starttag(self, tag, attrs):
            if tag == "a" and dict(attrs).get("href") is not None:
                self.links.append(dict(attrs)["href"])

    digest = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r for r in pages.collect()}
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 2 * len(source)
    responses = {r.page_id: r for r in warc.responses(pages).collect()}
    for row in rows:
        page, response = source[row.page_id], responses[row.page_id]
        assert row.refers_to == response.record_id and row.target_uri == page.url
        assert row.block_digest == digest(bytes(row.block))
        assert row.headers["X-Source-Payload-Digest"] == digest((page.html or "").encode())
        if row.record_type == "conversion":
            assert bytes(row.block).decode() == loop_text(page.html or "")
        else:
            parser = Links()
            parser.feed(page.html or "")
            lines = bytes(row.block).decode().split("\r\n")
            found = [line.removeprefix("outlink: ") for line in lines if line.startswith("outlink: ")]
            assert found == [warc.one_line(x) for x in dict.fromkeys(parser.links)]


@pytest.mark.parametrize("part", ["<!-- ", "<script ", "<script>", "<title>", "<a ", "<html ", "<p ", "<style><!--", "<"])
def test_pages_without_an_end_take_linear_time(part):
    row = {"record_type": "response", "record_id": "r", "target_uri": "u", "date": "d", "headers": {}, "block_digest": None, "payload_digest": None}
    begin = time.perf_counter()
    warc.derive(row | {"block": (part * (1_000_000 // len(part))).encode()})
    assert time.perf_counter() - begin < 10


def test_bit_table_lets_all_repeated_spans_through(spark):
    values = F.xxhash64(F.col("id") % 5000).alias("_h1")
    once = spark.range(20_000).select(F.xxhash64("id", F.lit("once")).alias("_h1"), F.lit(0).alias("_at"))
    twice = spark.range(10_000).select(values, F.lit(1).alias("_at"))
    spans = once.unionByName(twice)
    found = sentence_spans.maybe_repeated(spans)
    assert found.filter("_at = 1").count() == 10_000 and found.filter("_at = 0").count() < 2000
    assert sentence_spans.maybe_repeated(spans, most_bits=1).count() == 30_000


def test_each_part_of_the_shuffle_has_its_own_task(spark):
    df = spark.range(5000).withColumn("text", F.lit("x"))
    dealt = sharding.shuffle_into_shards(df, 7, block_rows=300)
    rows = dealt.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(rows) == 7 * 3 and max(r["count"] for r in rows) < 300
    slots = dealt.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b")).collect()
    assert all((r.a, r.b) == (0, r.n - 1) for r in slots) and len(slots) == 7


def test_spans_of_a_hot_passage(spark, monkeypatch):
    from osspulse.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 3)
    passage = " ".join(f"word{i} is here." if i % 9 == 8 else f"word{i}" for i in range(60))
    rows = [(i if i % 7 else None, f"Own {i} begin.\n{passage}\nOwn {i} end.") for i in range(40)] + [(50, passage + "\n" + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sentence_spans.remove_repeats(docs).collect()
    texts = {(r.doc_id, r.n_removed > 0) for r in found}
    assert len(found) == 41 and sum("word30" in r.text for r in found) == 1
    # The first of the rows without an id keeps it.
    assert (None, False) in texts and all(removed for i, removed in texts if i is not None)
