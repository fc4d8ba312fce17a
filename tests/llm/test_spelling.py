"""Spelling variants against all pairs of words within a fixture."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest

from osspulse.llm import spelling
from osspulse.llm.queries import op13_spelling_variants

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def loops(docs, least_length=5, least_count=3):
    n = Counter()
    for key, text in docs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}
    # Words that share what is left without one letter are the only ones that can be near.
    left = defaultdict(set)
    for w in n:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            left[key].add(w)
    near = {w: set() for w in n}
    for group in left.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_equals_loops(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = loops(docs)
    assert any(v[0] for v in want.values()) and any(v[1] != (v[0] or w) for w, v in want.items())
    assert found(op13_spelling_variants(spark, sf_dir)) == want


@pytest.mark.parametrize("seed", range(3))
def test_dense_words_of_few_letters(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÀ") for _ in range(rng.randint(4, 8))) for _ in range(400)]
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(spelling.group_variants(df)) == loops(docs)


def test_hot_nodes(spark, monkeypatch):
    from osspulse.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 5)
    rng = random.Random(9)
    words = ["commonprefix" + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 5))) for _ in range(200)]
    docs = [(i, " ".join(rng.choices(words, k=40))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(spelling.group_variants(df)) == loops(docs)


def test_chains_are_followed_to_their_end(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "zzzzzz": 3}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items(), 1000)]
    rows = found(spelling.group_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert rows == loops(docs)
    assert [rows[w][1] for w in ("aaaaa", "aaabb", "abbbb", "zzzzzz")] == ["abbbb", "abbbb", "abbbb", "zzzzzz"]


def test_only_second_halves_are_walked_and_only_edited_words(spark, monkeypatch):
    rows = {}

    def counted(df, label):
        out = stored(df, label)
        rows[label] = rows.get(label, 0) + out.count()
        return out

    stored = spelling.stored
    monkeypatch.setattr(spelling, "stored", counted)
    # Doubled letters: words share long beginnings and ends, and no two of them are one edit apart.
    words = ["".join(x) for x in product(("aa", "bb"), repeat=5)] + ["aabbaaccddz"]
    df = spark.createDataFrame([(i, " ".join(words)) for i in range(1000, 1004)], "doc_id long, text string")
    assert found(spelling.group_variants(df)) == loops([(i, " ".join(words)) for i in range(1000, 1004)])
    # Of a word's prefixes and suffixes, those that leave at most the other half; and one more where it is cut.
    assert rows["prefixes"] == sum(len(w) + 2 for w in words)
    assert rows["frontier"] == 0


@pytest.mark.parametrize("seed", range(2))
def test_runs_of_letters_and_words_within_words(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aàb") * rng.randint(1, 4) for _ in range(rng.randint(2, 4))) for _ in range(300)]
    words += [w + "a" for w in words[:100]] + [w[1:] for w in words[100:200]]
    docs = [(i, " ".join(rng.choices(words, k=80))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(spelling.group_variants(df)) == loops(docs)


def test_defined_results(spark):
    long = "q" * 3000 + "w" + "q" * 3000
    rows = [
        (None, "Straße straße STRAßE"), (1, None), (2, ""), (3, "$$ 12 _"), (4, "naïve Naïve naïve naive naive naive"),
        (4, "naïve Naïve naïve naive naive naive"), (5, " ".join([long, long, long, long[:-1], long[:-1], long[:-1]])),
        (6, "ÀÀÀÀÀ àààÀÀ ÀÀÀÀÀ ÀÀÀÀÀ"), (7, "word " * 100_000), (8, "x" * 1_000_000),
    ]
    schema = "doc_id long, text string, word string, n string, key string"
    df = spark.createDataFrame([(*r, "w", "n", "k") for r in rows], schema)
    assert found(spelling.group_variants(df)) == loops(rows)
    assert spelling.group_variants(df.limit(0)).collect() == []
    assert spelling.group_variants(df.limit(0)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
