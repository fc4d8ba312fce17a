"""Benchmark decontamination by Wu-Manber search for many strings at once.

Test items are cut into windows of words, texts and windows are written as words between single
spaces, and a window is a string to search for. Of the strings in a length class, the shortest has m bytes. A table tells
for every block of bytes how far the search may shift if the block ends a window of m bytes: as far as no
string can end. Where it may not shift, the block's hash and that of the string's beginning pick the
strings of one bucket, and these are compared with the text byte by byte. The search runs at many places
of a batch of texts at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import ALNUM, Texts, mix
from osspulse.llm.common import renamed, stored, with_arrow_columns, without

WINDOW = 13
# Bytes of test text that one pass over the documents searches for.
PASS_BYTES = 1 << 20
# Strings are searched by class of length, so that a short one does not shorten all shifts.
CLASSES = (1, 8, 24, 48)
LANE = 512
SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType())]))


class Words:
    """Texts as ` word word `, one behind the other; two spaces lie between texts."""

    def __init__(self, column: pa.Array):
        texts = Texts(column, lower=True, gap=2)
        starts, ends = texts.spans(ALNUM)
        keep = ALNUM[texts.data]
        keep[ends] = keep[texts.begin - 1] = True
        texts.data[ends] = texts.data[texts.begin - 1] = 0x20
        place = np.cumsum(keep) - 1
        self.flat = np.concatenate((texts.data[keep], np.zeros(8, np.uint8)))
        self.begin, self.starts, self.ends = place[texts.begin - 1], place[starts], place[ends]
        self.first = texts.first_of(starts)
        self.n_words = np.diff(self.first)

    def blocks(self) -> np.ndarray:
        """The eight bytes from each place on."""
        return np.ndarray((len(self.flat) - 7,), "<u8", buffer=self.flat, strides=(1,))


class Patterns:
    """The windows of some items and the tables to search for them."""

    def __init__(self, items: Sequence[tuple[str | None, str | None]], window: int):
        words = Words(pa.array([text for _, text in items], pa.string()))
        self.names = [name for name, _ in items]
        runs = np.where(words.n_words == 0, 0, np.maximum(1, words.n_words - window + 1))
        of_item = np.repeat(np.arange(len(items)), runs)
        at = np.repeat(words.first[:-1] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        upto = np.minimum(at + window, np.repeat(words.first[1:], runs)) - 1
        begin, length = words.starts[at] - 1, words.ends[upto] - words.starts[at] + 2
        self.raw = words.flat.tobytes()
        self.classes = []
        for low, high in zip(CLASSES, (*CLASSES[1:], 1 << 60), strict=True):
            use = np.flatnonzero((length >= low) & (length < high))
            if len(use):
                self.classes.append(LengthClass(words.blocks(), begin[use], length[use], of_item[use]))


class LengthClass:
    def __init__(self, blocks: np.ndarray, begin: np.ndarray, length: np.ndarray, item: np.ndarray):
        self.m = int(length.min())
        self.size = min(8, self.m)
        self.mask = np.uint64((1 << 8 * self.size) - 1)
        self.bits = np.uint64(min(24, max(16, int(8 * len(begin)).bit_length() + 2)))
        self.shift = np.full(1 << int(self.bits), min(self.m - self.size + 1, 32767), np.int16)
        for shift in range(min(self.m - self.size, 32766), -1, -1):
            self.shift[self.slot(blocks[begin + self.m - self.size - shift] & self.mask)] = shift
        keys = self.bucket(blocks[begin + self.m - self.size] & self.mask, blocks[begin] & self.mask)
        order = np.argsort(keys, kind="stable")
        self.keys, self.begin, self.length, self.item = (x[order] for x in (keys, begin, length, item))

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks * np.uint64(0x9E3779B97F4A7C15)) >> (np.uint64(64) - self.bits)

    def bucket(self, suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return mix(suffix) ^ (prefix * np.uint64(0xC2B2AE3D27D4EB4F))

    def search(self, words: Words, raw: bytes, patterns: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, lengths and items of all occurrences."""
        blocks, last = words.blocks(), len(words.flat) - 8 - self.m
        at = np.arange(0, last + 1, LANE)
        stop = np.minimum(at + LANE, last + 1)
        places = []
        while len(at):
            shift = self.shift[self.slot(blocks[at + self.m - self.size] & self.mask)]
            places.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        keys = self.bucket(blocks[place + self.m - self.size] & self.mask, blocks[place] & self.mask)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        n = high - low
        place = np.repeat(place, n)
        which = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        length, begin = self.length[which], self.begin[which]
        same = np.fromiter(
            (
                raw[p : p + size] == patterns[b : b + size]
                for p, b, size in zip(place.tolist(), begin.tolist(), length.tolist(), strict=True)
            ),
            bool,
            len(place),
        )
        return place[same], length[same], self.item[which][same]


def contamination(column: pa.Array, patterns: Patterns) -> list[pa.Array]:
    """Number of words, runs of hit words and ids of the items found, for each text."""
    words = Words(column)
    raw = words.flat.tobytes()
    found = [c.search(words, raw, patterns.raw) for c in patterns.classes]
    n = len(words.begin)
    spans: list[list] = [[] for _ in range(n)]
    names: list[set] = [set() for _ in range(n)]
    if sum(len(f[0]) for f in found):
        place, length, item = (np.concatenate(x) for x in zip(*found, strict=True))
        steps = np.zeros(len(words.flat) + 1, np.int32)
        np.add.at(steps, place, 1)
        np.add.at(steps, place + length - 1, -1)
        hit = np.cumsum(steps)[words.starts] > 0
        text_of = np.repeat(np.arange(n), words.n_words)
        joined = hit[1:] & hit[:-1] & (text_of[1:] == text_of[:-1])
        begins = np.flatnonzero(hit & ~np.concatenate(([False], joined)))
        ends = np.flatnonzero(hit & ~np.concatenate((joined, [False])))
        for text, a, b in zip(text_of[begins].tolist(), begins.tolist(), ends.tolist(), strict=True):
            spans[text].append({"first": a - int(words.first[text]), "words": b - a + 1})
        owner = np.searchsorted(words.begin, place, "right") - 1
        for pair in np.unique(owner * len(patterns.names) + item).tolist():
            text, name = divmod(pair, len(patterns.names))
            if patterns.names[name] is not None:
                names[text].add(patterns.names[name])
    kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
    return [pa.array(words.n_words), pa.array(spans, kind), pa.array([sorted(x) for x in names], pa.list_(pa.string()))]


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def scan(docs: DataFrame, items: list, text: str, window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Patterns(items, window))

    def compute(column: pa.Array) -> list[pa.Array]:
        return contamination(column, shared.value)

    return with_arrow_columns(docs, text, FIELDS, compute)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """`docs` with `n_words`, `n_hit`, `hit_spans` (runs of hit words) and `items` (ids found, sorted as strings).

    A word is hit inside an occurrence of `window` consecutive words of an item, or of a whole shorter
    item. Null texts have no words. Words of items without an id are hit, but no id is listed; repeated
    items count once. A benchmark of more than `pass_bytes` takes several passes over the documents,
    each with its part of the items.
    """
    own = ["n_words", "n_hit", "hit_spans", "items"]
    tests = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).cast("string").alias("t"))
    tests = tests.filter("t is not null").distinct()
    size = tests.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    passes = max(1, -(-size // pass_bytes))
    found = without(docs, own)
    for k in range(passes):
        part = tests.filter(F.pmod(F.xxhash64("name", "t"), F.lit(passes)) == k)
        items = [(row.name, row.t) for row in part.collect()]
        if k == 0:
            found = scan(found, items, text, window)
            continue
        before = stored(found.withColumnsRenamed({"hit_spans": "_spans", "items": "_items"}), "hits")
        found = scan(before, items, text, window)
        found = found.withColumn("hit_spans", F.concat("_spans", "hit_spans")).withColumn(
            "items", F.array_sort(F.array_distinct(F.concat("_items", "items")))
        )
        found = found.drop("_spans", "_items")
    if passes == 1:
        n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    else:
        places = F.transform("hit_spans", lambda s: F.sequence(s["first"], s["first"] + s["words"] - 1))
        n_hit = F.size(F.array_distinct(F.flatten(places))).cast("long")
    return found.withColumn("n_hit", n_hit)


def is_contaminated(one_in: int = 20):
    """At least one word in `one_in` is hit."""
    return (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that are not contaminated, with the columns of `docs` alone."""
    plain, names, back = renamed(docs)
    return find_contamination(plain, benchmark, names[text], **settings).filter(~is_contaminated()).select(back)
