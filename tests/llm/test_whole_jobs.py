"""The registered queries do the whole job: what the reviews found missing."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import brute
from osspulse.llm import packing, sentence_spans, sharding, simhash
from osspulse.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain_tokenizer():
    """The tokenizer as its file has it, with nothing set."""
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_added_tokens_inside_texts(plain_tokenizer):
    random.seed(6)
    marks = [" ", "  ", "\n", "a", "B", "é", "'s", "!", "中", "\t", "<", "|>", *["<|endoftext|>"] * 3]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|>" * 3, None, "", "a <|endoftext|>", "<|endoftext|> a"]
    texts += ["".join(random.choice(marks) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    vocabulary = packing.default_vocabulary()
    ids, first = packing.token_ids(pa.array(texts, pa.string()), vocabulary, 0, packing.added_tokens(vocabulary))
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == plain_tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_hold_added_tokens(spark, plain_tokenizer):
    texts = {1: "hello <|endoftext|> world", 2: "x <|endoftext|>" * 1500, 3: "plain"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.token_pieces(docs).collect()
    found = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == sorted((d, *p) for d, t in texts.items() for p in brute.pieces(t, plain_tokenizer))
    assert np.frombuffer(rows[0].ids, "<u4").tolist() == [31373, 220, 50256, 995, 0]


def test_documents_reach_their_shards(spark, sf_dir, monkeypatch):
    passed = []
    shuffle = sharding.shuffle_into_shards
    monkeypatch.setattr(sharding, "shuffle_into_shards", lambda df, *a, **b: passed.append(df) or shuffle(df, *a, **b))
    rows = QUERIES["op8_hypergeometric_shards"](spark, sf_dir).collect()
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert passed[0].columns == source.columns
    raw = {r.doc_id: (r.text or "").encode() for r in source.collect()}
    assert len(rows) == len(raw)
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {k: (len(v) + 16, zlib.crc32(v)) for k, v in raw.items()}


def test_no_passage_of_51_words_is_missed(spark, sf_dir):
    rng, rows = random.Random(7), []
    word = lambda: f"w{rng.randrange(10**9)}"
    for case in range(600):
        every = (None, rng.randint(20, 30), rng.randint(5, 12))[case % 3]
        at = rng.randrange(every) if every else 0
        passage = [f"p{case}x{word()}" + ("." if every and (i + at) % every == 0 else "") for i in range(51)]
        for side in range(2):
            before, after = ([word() + rng.choice([""] * 9 + ["."]) for _ in range(rng.randint(0, 40))] for _ in range(2))
            rows.append((2 * case + side, " ".join([*before, *passage, *after])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in sentence_spans.remove_repeats(docs).collect()}
    for doc, text in rows:
        left = [w for w in found[doc].split() if w.startswith("p")]
        if doc % 2 == 0:
            assert found[doc] == text
        else:
            assert len(left) <= 51 - 32, (doc, len(left))
            assert [w for w in found[doc].split() if w[0] == "w"] == [w for w in text.split() if w[0] == "w"]


def test_aligned_spans_against_loops(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r.doc_id: r.text for r in QUERIES["op2_sentence_span_dedup"](spark, sf_dir).collect()}
    assert found == brute.remove_repeats(texts)


def test_keep_one_tells_texts_of_one_id_apart(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in ("one", "two"))
    other, third = (" ".join(f"{x}{i}" for i in range(60)) for x in ("other", "third"))
    rows = [(1, one), (2, two), (2, two), (2, one), (3, other), (3, third), (4, third), (5, two + "\n"), (5, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    assert found == sorted([(1, one), (2, two), (3, other), (3, third)])
    twice = spark.createDataFrame([(5, two + "\n"), (5, two)], "doc_id long, text string")
    assert simhash.keep_one(twice).count() == 1
