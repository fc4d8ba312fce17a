"""The operators against plain loops, round trips and held-out labels."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import brute
from tokenizers import Tokenizer

import corpus_pipeline
from osspulse.llm import decontaminate, langid, packing, quality, sentence_spans, sharding, simhash, warc
from osspulse.llm.components import connected_components
from osspulse.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


@pytest.mark.parametrize("pass_bytes", [1 << 20, 2000])
def test_contamination(spark, sf_dir, docs, texts, pass_bytes):
    extra = spark.createDataFrame([(901, "the of"), (902, "de"), (903, None), (904, ""), (905, "a")], "item_id long, text string")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").unionByName(extra)
    want = brute.contamination(texts, [(r.item_id, r.text) for r in bench.collect()])
    found = decontaminate.find_contamination(docs, bench, pass_bytes=pass_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == want


def test_repeated_spans(docs, texts):
    want = brute.remove_repeats(texts)
    assert any(want[k] != texts[k] for k in texts)
    found = {r.doc_id: r.text for r in sentence_spans.remove_repeats(docs).collect()}
    assert found == want


def test_a_passage_without_the_rest(spark):
    passage = " ".join(f"word{i} is here." if i % 9 == 8 else f"word{i}" for i in range(55))
    rows = [(1, f"First text. {passage} Its end."), (2, f"Quite another one\n{passage} and more"), (3, "Clean. Text. " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in sentence_spans.remove_repeats(docs).collect()}
    assert found[1].n_removed == 0 and found[3].n_removed == 0
    assert "word20" not in found[2].text and found[2].text.startswith("Quite another one") and "more" in found[2].text


def test_token_ids(texts, tokenizer):
    random.seed(5)
    marks = [" ", "  ", "\n", "a", "B", "é", "'s", " '", "1", "　", " ", "!", "中", "\x1c", "\x85", "\t", "¡", "🙂", "<|endoftext|>"]
    odd = ["".join(random.choice(marks) for _ in range(random.randint(0, 40))) for _ in range(2000)]
    all_texts = [*list(texts.values())[:60], None, "", *odd]
    ids, first = packing.token_ids(pa.array(all_texts, pa.string()), packing.default_vocabulary())
    for i, text in enumerate(all_texts):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert ids[first[i] : first[i + 1]].tolist() == want


def packed(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("settings", [{}, {"node_items": 40, "fan_in": 3}])
def test_packing(docs, texts, tokenizer, settings):
    rows = packing.pack(packing.token_pieces(docs.select("doc_id", "text"), keep_ids=False), **settings).collect()
    found = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == sorted((d, *p) for d, t in texts.items() for p in brute.pieces(t, tokenizer))
    assert packed(rows, 2048) <= 1.06 * -(-sum(r.length for r in rows) // 2048)


def test_sequences_hold_the_tokens(spark, tokenizer):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "three " * 3000)], "doc_id long, text string")
    made = packing.pack(packing.token_pieces(docs))
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(made).collect()}
    ids = {1: "one two", 2: "", 3: "three " * 3000}
    ids = {k: tokenizer.encode(v, add_special_tokens=False).ids + [0] for k, v in ids.items()}
    for r in made.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]


def test_a_bin_merges_in_a_later_round(spark):
    rows = spark.createDataFrame([(i, 700) for i in range(31)], "id long, length long")
    found = packing.pack(rows, capacity=2100, node_items=2, fan_in=4).collect()
    assert packed(found, 2100) <= 16 and len(found) == 31


def test_shards(docs, texts):
    rows = sharding.shuffle_into_shards(docs.select("doc_id"), 7, block_rows=16).collect()
    held = defaultdict(list)
    for r in rows:
        held[r.shard].append(r.slot)
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    assert all(sorted(slots) == list(range(len(slots))) for slots in held.values())
    sizes = [len(slots) for slots in held.values()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    other = sharding.shuffle_into_shards(docs.select("doc_id"), 7, seed=1, block_rows=16).collect()
    assert {(r.doc_id, r.shard) for r in rows} != {(r.doc_id, r.shard) for r in other}


@pytest.mark.parametrize("good, bad, drawn", [(30, 70, 20), (5, 3, 4), (1, 999, 10), (400, 600, 999)])
def test_hypergeometric(good, bad, drawn):
    rng = np.random.default_rng(1)
    own = np.array([sharding.hypergeometric(rng, good, bad, drawn) for _ in range(4000)])
    total = good + bad
    mean = drawn * good / total
    variance = mean * (bad / total) * (total - drawn) / (total - 1)
    assert abs(own.mean() - mean) < 5 * (variance / 4000) ** 0.5 + 1e-9
    assert abs(own.var() - variance) < 0.15 * variance + 1e-3
    assert own.min() >= max(0, drawn - bad) and own.max() <= min(good, drawn)


def test_every_permutation_is_as_likely():
    counts = defaultdict(int)
    for seed in range(3000):
        plan = sharding.Plan({0: 2, 1: 2}, 2, seed, 2)
        part, arrival = plan.deal(np.array([0, 1, 1 << 33, (1 << 33) + 1]))
        shard, slot = plan.settle(part, arrival)
        counts[tuple((2 * shard + slot).tolist())] += 1
    assert len(counts) == 24
    assert sum((n - 125) ** 2 / 125 for n in counts.values()) < 60


def test_matrix_sums():
    matrix = sharding.communication_matrix(np.random.default_rng(3), [5, 0, 7, 9], [10, 10, 1])
    assert matrix.sum(axis=1).tolist() == [5, 0, 7, 9] and matrix.sum(axis=0).tolist() == [10, 10, 1]
    assert sharding.hypergeometric(np.random.default_rng(1), 7 * 10**8, 3 * 10**10, 10**7) == pytest.approx(228000, rel=0.01)


def test_near_groups(docs, texts):
    values = {k: brute.fingerprint(v) for k, v in texts.items()}
    want = brute.components(values)
    found = simhash.near_groups(docs).collect()
    assert {r.doc_id: r.fingerprint & (2**64 - 1) for r in found} == values
    assert {r.doc_id: r.component_id for r in found} == want


@pytest.mark.parametrize("node_rows", [4096, 50])
def test_links_of_dense_clusters(spark, node_rows):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    near = [base]
    for _ in range(60):
        flips = np.uint64(1) << rng.integers(0, 64, (rng.integers(1, 5), 12)).astype(np.uint64)
        near.append(base ^ np.bitwise_or.reduce(flips, axis=0))
    values = {int(v): int(v) & (2**64 - 1) for v in np.unique(np.concatenate(near)).view(np.int64)}
    links = simhash.hamming_links(spark.createDataFrame([(v,) for v in values], "fingerprint long"), 3, node_rows)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    assert {v: roots.get(v, v) for v in values} == brute.components(values)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (3, 2)], "a long, b long")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_quality(spark, sf_dir, docs, texts):
    found = quality.with_statistics(docs).collect()
    assert all(tuple(r[c] for c in quality.STATISTICS) == brute.statistics(texts[r.doc_id]) for r in found)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op7_boosted_quality_rules"](spark, sf_dir).collect()
    judged = [r for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(r.kept == bool(labels[r.doc_id]) for r in judged) > 0.9 * len(judged)


def test_scores_fall_with_bad_features():
    rng = np.random.default_rng(4)
    x = rng.random((600, len(quality.FEATURES)))
    y = (x[:, 2] + x[:, 0] + 0.3 * rng.random(600) < 1.1).astype(int)
    trees = quality.fit(x, y)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.9
    for f, direction in enumerate(quality.FEATURES.values()):
        if direction:
            grid = np.repeat(x[:50], 30, axis=0)
            grid[:, f] = np.tile(np.linspace(0, 1, 30), 50)
            assert (np.diff(trees.score(grid).reshape(50, 30), axis=1) <= 1e-12).all()
    assert quality.fit(x, np.ones(600, int)) is None


def test_languages_held_out(spark, docs):
    rows = langid.identify(docs).collect()
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 20 and sum(r.lang_pred == r.lang for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 for r in rows)


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 12, 40):
        code = langid.codewords(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert len(code) == n and min(gaps) >= max(1, code.shape[1] // 5)


def test_warc_round_trip(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sources = {r.record_id: r for r in warc.responses(pages).collect()}
    made = warc.derivatives(warc.responses(pages)).collect()
    assert len(made) == 2 * len(sources)
    path = tmp_path / "made.warc"
    path.write_bytes(b"".join(r.warc for r in made))
    back = {r.record_id: r for r in warc.read_warc(spark, str(path)).collect()}
    by_id = {r.record_id: r for r in made}
    assert set(back) == set(by_id)
    for key, row in back.items():
        for field in warc.RECORD.names:
            assert (row[field] or {}) == (by_id[key][field] or {})
        source = sources[row.refers_to]
        assert row.target_uri == source.target_uri and row.headers["X-Source-Payload-Digest"] == source.payload_digest
        assert warc.digest(row.block) == row.block_digest
        if row.record_type == "conversion":
            assert b"<p" not in row.block and row.block
        else:
            assert b"http-header-content-type: text/html" in row.block


def test_pipeline(spark, sf_dir, texts, tokenizer):
    kept = {k: t for k, t in texts.items() if any(c.isalpha() for c in t or "")}
    first = brute.components({k: brute.fingerprint(t) for k, t in kept.items()})
    kept = brute.remove_repeats({k: t for k, t in kept.items() if first[k] == k})
    kept = {k: t for k, t in kept.items() if t == texts[k] or t.strip()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hits = brute.contamination(kept, items)
    kept = {k: t for k, t in kept.items() if not (hits[k][1] > 0 and 20 * hits[k][1] >= hits[k][0])}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    found = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == sorted((d, *p) for d, t in kept.items() for p in brute.pieces(t, tokenizer))
    packed(rows, 2048)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_spans", "benchmark", "pack"]
