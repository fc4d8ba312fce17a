"""Alignment of two tokenizers against plain loops over all tokens, and its perfect hash."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from osspulse.llm import alignment
from osspulse.llm.queries import op11_perfect_hash_alignment

ODD = [
    None, "", " ", "  x", "a  b   c", " lead", "trail ", "\n x \n\n  y\t z", "▁a b", "a\x00b c", "<|endoftext|> hi <s> x",
    "é́ ñ 中文 𝔘x  ", "x y 　 z", " a", "don't  it's I'll", "… ¿", " " * 50 + "x " + " " * 7, "same same", "same same",
]
NOTHING = (0, 0, 0, 0, 0, 0, "")


def loops(texts):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters, names = alignment.byte_of_letter(), {i: t for t, i in a.get_vocab().items()}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def ends(ids, raw):
        at, out = 0, {}
        for i in ids:
            at += len(raw(i))
            out[at] = i
        return out

    rows, counts = [], Counter()
    for text in texts:
        row = None
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            of_a = lambda i: bytes(letters[c] for c in names[i])
            if b"".join(map(of_a, x)) == b"".join(map(piece, y)) == (" " + text).encode():
                at_a, at_b = ends(x, of_a), ends(y, piece)
                cuts = sorted(at_a.keys() & at_b.keys())
                groups, low = [], 0
                for cut in cuts:
                    parts = [",".join(str(i) for e, i in at.items() if low < e <= cut) for at in (at_a, at_b)]
                    groups.append("|".join(parts))
                    low = cut
                row = len(x), len(y), [(at_a[c], at_b[c]) for c in cuts], ";".join(groups)
                counts.update(row[2])
        rows.append(row)
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        NOTHING if r is None else (
            r[0], r[1], len(r[2]), len(r[2]), sum(counts[k] == highest[k[1]] for k in r[2]), sum(counts[k] for k in r[2]), r[3],
        )
        for r in rows
    ]


def found(df):
    return {r.doc_id: tuple(r[c] for c in (*alignment.COUNTS, "groups")) for r in df.collect()}


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").orderBy("doc_id").limit(80).collect()
    return [r.text[:1500] for r in rows if r.text] + ODD


def test_alignment_equals_loops(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(alignment.align(docs)) == dict(enumerate(loops(texts)))


def test_shards_change_nothing(spark, texts, monkeypatch):
    monkeypatch.setattr(alignment, "BUCKET_KEYS", 64)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(19)
    assert found(alignment.align(docs, shard_keys=500)) == dict(enumerate(loops(texts)))


def test_query_has_the_digest_and_whole_texts(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op11_perfect_hash_alignment(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    short = [i for i, t in texts.items() if t and len(t) < 2000][:30]
    a = loops([texts[i] for i in short])
    for i, want in zip(short, a, strict=True):
        got = rows[i]
        assert (got.n_a, got.n_b, got.n_groups, got.n_links) == want[:4]
        assert got.groups_sha256 == (hashlib.sha256(want[6].encode()).hexdigest() if want[6] else "")


def test_empty_tables_and_clashing_columns(spark):
    schema = "doc_id long, text string, n_a string, groups string, pair string, hash int"
    assert alignment.align(spark.createDataFrame([], schema)).collect() == []
    docs = spark.createDataFrame([(None, "one two", "x", "y", "z", 1), (2, None, "x", "y", "z", 1)], schema)
    rows = alignment.align(docs).collect()
    assert sorted((r.doc_id or 0, r.n_groups, r.pair, r["hash"]) for r in rows) == [(0, 2, "z", 1), (2, 0, "z", 1)]


def test_a_very_long_text(spark):
    text = "word by word " * 50_000 + "x" * 50_000 + " " * 50_000
    docs = spark.createDataFrame([(1, text), (2, "word")], "doc_id long, text string")
    rows = {r.doc_id: r for r in alignment.align(docs).collect()}
    assert rows[1].n_groups >= 150_000 and rows[2].count_sum > 100_000


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    hashes = alignment.hash_of(np.random.default_rng(n).permutation(10 * n)[:n].astype(np.int64))
    made = alignment.PerfectHash.build(hashes)
    assert sorted(made.slots(hashes).tolist()) == list(range(n))
    assert len(made.bits) <= 5 * n + 16
