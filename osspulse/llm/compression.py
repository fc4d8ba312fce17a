"""A quality classifier by compression: texts that a dictionary of good texts helps more than one of bad texts are good.

Two zstandard dictionaries are trained, from good and from bad labelled texts. Every text is compressed with both, block by
block, so that a long text leans on the dictionaries throughout and not only at its start. The difference of the two
sizes per byte of text becomes a probability by isotonic calibration on labelled texts that the dictionaries have
not seen. Text that repeats itself needs neither dictionary, so it has no difference, where good text has a clear one.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import flatten
from osspulse.llm.common import bounded_sample, least_hashed, with_arrow_columns, without

# Labelled texts of one class that the model is learned from, and bytes of text of one class.
SAMPLE_TEXTS, SAMPLE_BYTES = 4000, 8_000_000
DICTIONARY_BYTES, BLOCK, LEVEL = 1 << 16, 1 << 10, 3
FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def blocks(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


def build_dictionary(texts: Sequence[bytes], size: int, block: int) -> bytes:
    """A trained dictionary; where there is too little text for the trainer, the texts' own last bytes."""
    samples = [part for text in texts for part in blocks(text, block)]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


@dataclass
class Model:
    """Dictionaries of class 0 and 1, and a rising curve from difference to probability. Without dictionaries: its first value."""

    dictionaries: tuple[bytes, bytes] | None
    differences: np.ndarray
    chances: np.ndarray
    block: int = BLOCK
    _made: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_made": []}

    def sizes(self, column: pa.Array) -> np.ndarray:
        """Compressed bytes of each text with each dictionary."""
        if not self._made:
            for raw in self.dictionaries or ():
                known = zstandard.ZstdCompressionDict(raw)
                known.precompute_compress(level=LEVEL)
                self._made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False))
        data, offsets = flatten(column)
        raw, out = memoryview(np.ascontiguousarray(data)), np.zeros((len(offsets) - 1, 2), np.int64)
        for i, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for at in range(begin, end, self.block):
                part = raw[at : min(end, at + self.block)]
                for k, compressor in enumerate(self._made):
                    out[i, k] += len(compressor.compress(part))
        return out

    def difference(self, column: pa.Array) -> np.ndarray:
        """How much smaller a byte of text gets with the good dictionary; 0 for empty and null texts."""
        bad, good = self.sizes(column).T
        return (bad - good) / np.maximum(np.diff(flatten(column)[1]), 1)

    def score(self, column: pa.Array) -> np.ndarray:
        if not self.dictionaries:
            return np.full(len(column), self.chances[0])
        return np.interp(self.difference(column), self.differences, self.chances)


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising curve that fits best: neighbours in x that fall are pooled; a pool has its share of ones, straight lines lie between pools."""
    pools: list[list[float]] = []  # weight, weighted ones, first x, last x
    order = np.argsort(x, kind="stable")
    for a, b, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist(), strict=True):
        pools.append([w, w * b, a, a])
        while len(pools) > 1 and (pools[-1][2] == pools[-2][3] or pools[-1][1] * pools[-2][0] <= pools[-2][1] * pools[-1][0]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    w, ones, first, last = (np.array(column) for column in zip(*pools, strict=True))
    # Half a row of each class keeps pools of one class off 0 and 1.
    half = float(weight.mean()) / 2
    chances = np.maximum.accumulate((ones + half) / (w + 2 * half))
    return np.stack([first, last], axis=1).ravel(), np.repeat(chances, 2)


def fit(rows: Sequence[tuple], counts: dict, block: int = BLOCK, dictionary_bytes: int = DICTIONARY_BYTES) -> Model:
    """A model from rows (label, id, text); `counts`: how often each label occurs where the rows come from."""
    total = sum(counts.values())
    if len({r[0] for r in rows}) < 2:
        share = counts.get(1, 0) / total if total else 0.5
        return Model(None, np.zeros(1), np.array([float(share)]), block)
    texts: dict[int, list[list[bytes]]] = {0: [[], []], 1: [[], []]}
    # Even rows of a class, in the order of a checksum, make the dictionary; odd ones the calibration.
    for label in texts:
        mine = sorted((zlib.crc32(r[2].encode()), r[2].encode()) for r in rows if r[0] == label)
        for i, (_, text) in enumerate(mine):
            texts[label][i % 2 if len(mine) > 1 else 0].append(text)
        texts[label][1] = texts[label][1] or texts[label][0]
    both = tuple(build_dictionary(texts[label][0], dictionary_bytes, block) for label in (0, 1))
    model = Model(both, np.zeros(1), np.full(1, 0.5), block)
    tests = [(label, text.decode()) for label in texts for text in texts[label][1]]
    y = np.array([label for label, _ in tests], float)
    x = model.difference(pa.array([text for _, text in tests], pa.string()))
    taken = np.bincount(y.astype(int), minlength=2)
    weight = np.array([counts[0] / taken[0], counts[1] / taken[1]])[y.astype(int)]
    model.differences, model.chances = calibrate(x, y, weight * len(y) / weight.sum())
    return model


def held_out(id: str) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_texts: int = SAMPLE_TEXTS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """A model from a bounded sample of the labelled documents that are not held out.

    A document with several labels counts by their mean; null ids and labels teach nothing.
    """
    known = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out(id))
    known = known.groupBy(F.col(id).alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    # Chosen among the ids first, so that the documents meet a few rows only.
    few, counts = least_hashed(known, "_label", "_id", sample_texts)
    few = F.broadcast(few.drop("_rank"))
    texts = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text")).join(few, "_id")
    rows, _ = bounded_sample(texts, "_label", "_id", "_text", sample_texts, sample_bytes)
    return fit(rows, counts)


def rate(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from 0.5 on).

    Empty and null texts have no difference, and the chance that goes with it. Without labelled texts of both
    classes all rows get the share of class 1 (0.5 without any).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(column: pa.Array) -> list[pa.Array]:
        score = shared.value.score(column)
        return [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]

    return with_arrow_columns(docs, text, FIELDS, compute)


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", **bounds) -> DataFrame:
    """`docs` with `held_out`, `score` and `predicted`, after learning from the labels that are not held out."""
    model = train(docs, labels, id, text, label, **bounds)
    return rate(without(docs, ["held_out"]).withColumn("held_out", held_out(id)), model, text)
