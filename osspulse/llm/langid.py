"""Language identification by error-correcting output codes over character n-grams.

Each language has a codeword. For each of its bits a binary classifier learns to tell the languages whose bit is set
from the others: a weight per hashed byte n-gram, fitted by logistic regression from log-odds of counts. A text is
given the language whose codeword loses least against the classifiers' margins, weighted by how
sure each bit proved to be. If the second best is nearly as near, the text is marked ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import LOWER, Texts
from osspulse.llm.common import SLICE_BYTES, bounded_sample, with_arrow_columns, without

UNKNOWN = "und"
# Labelled texts of one language that the classifiers learn from, and bytes of text of one language.
SAMPLE_TEXTS, SAMPLE_BYTES = 200, 1_000_000
BITS = 15
MARGIN = 0.05


def codewords(n: int) -> np.ndarray:
    """Codewords of +1 and -1: all splits of few languages, else well separated ones drawn from a fixed seed."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        splits = range(1, 1 << (n - 1))
        return np.array([[1 if split >> i & 1 else -1 for split in splits] for i in range(n)], float)
    length = int(np.ceil(10 * np.log2(n)))
    rng, best, best_gap = np.random.default_rng(n), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, length))
        used = np.abs(code.sum(axis=0)) < n
        gap = min((code[i] != code[j])[used].sum() for i in range(n) for j in range(i))
        if gap > best_gap:
            best, best_gap = code[:, used], gap
    return best


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 2- to 4-byte windows of all texts (white space as one kind of byte), and where each text begins.

    ASCII letters are lower-cased; digits and marks count as white space.
    """
    texts = Texts(column, gap=4)
    data = LOWER[texts.data]
    letter = (data >= 0x61) & (data <= 0x7A) | (data >= 0x80)
    data = np.where(letter, data, 0x20).astype(np.uint32)
    two = data[:-3] << np.uint32(8) | data[1:-2]
    three = two << np.uint32(8) | data[2:-1]
    four = three << np.uint32(8) | data[3:]
    mask = letter[:-3] | letter[1:-2]
    tables = []
    for i, values in enumerate((two, three, four)):
        tables.append((values * np.uint32(0x9E3779B1) + np.uint32(i * 0x3C6EF372)) >> np.uint32(32 - BITS))
    at = np.flatnonzero(mask)
    bounds = np.append(np.searchsorted(at, texts.begin - 1), len(at))
    return np.stack([t[at] for t in tables], axis=1), bounds


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # n-gram slots x bits
    bias: np.ndarray
    sure: np.ndarray  # weight of each bit's loss

    def margins(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Mean of the weights of each text's n-grams, per bit, and the number of n-grams."""
        slots, bounds = grams(column)
        n = np.diff(bounds)
        values = self.weights[slots[:, 0]]
        values += self.weights[slots[:, 1]]
        values += self.weights[slots[:, 2]]
        out = np.zeros((len(n), values.shape[1]))
        full = np.flatnonzero(n)
        if len(full):
            out[full] = np.add.reduceat(values, bounds[:-1][full], axis=0) / n[full, None]
        return out + self.bias, n

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share of the likeness of all, and whether another is nearly as near."""
        signed = margins[:, None, :] * self.code[None, :, :]
        loss = (np.logaddexp(0, -signed) * self.sure).sum(axis=2) / self.sure.sum()
        best = loss.argmin(axis=1)
        share = np.exp(-loss * self.code.shape[1])
        share /= share.sum(axis=1, keepdims=True)
        gap = np.partition(loss, 1, axis=1) if len(self.languages) > 1 else np.stack([loss[:, 0], loss[:, 0] + 1], axis=1)
        return best, share[np.arange(len(best)), best], gap[:, 1] - gap[:, 0] < MARGIN


def fit(texts: list[str], labels: list[str], rounds: int = 15, rate: float = 4.0) -> Model:
    """Binary classifiers for the bits of the codewords, from whole texts."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    of = np.array([languages.index(x) for x in labels], np.int64)
    slots_n = 1 << BITS
    rows, cols, values = [], [], []
    counts = np.zeros((len(languages), slots_n))
    for i in range(0, len(texts), 64):
        slots, bounds = grams(pa.array(texts[i : i + 64], pa.string()))
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if a == b:
                continue
            found, n = np.unique(slots[a:b], return_counts=True)
            rows.append(np.full(len(found), i + k))
            cols.append(found)
            values.append(n / (b - a))
            counts[of[i + k], found] += n
    if not rows or len(languages) < 2:
        return Model(languages, code, np.zeros((slots_n, code.shape[1]), np.float32), code[0] * 1.0 if len(languages) else np.zeros(1), np.ones(code.shape[1]))
    rows, cols, values = np.concatenate(rows), np.concatenate(cols), np.concatenate(values)
    weights = np.zeros((slots_n, code.shape[1]))
    for bit in range(code.shape[1]):
        ones, zeros = (counts[code[:, bit] == side].sum(axis=0) + 0.5 for side in (1, -1))
        weights[:, bit] = np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())
    bias = np.zeros(code.shape[1])
    target, balance = code[of], np.bincount(of, minlength=len(languages))
    weight = (1 / balance[of])[:, None] / len(languages)
    sure = np.ones(code.shape[1])
    for _ in range(rounds):
        for bit in range(code.shape[1]):
            margin = np.bincount(rows, values * weights[cols, bit], len(texts)) + bias[bit]
            pull = target[:, bit] / (1 + np.exp(np.clip(target[:, bit] * margin, -30, 30))) * weight[:, 0]
            weights[:, bit] += rate * np.bincount(cols, values * pull[rows], slots_n) - 1e-4 * weights[:, bit]
            bias[bit] += 0.1 * pull.sum()
            sure[bit] = (weight[:, 0] * (margin * target[:, bit] > 0)).sum()
    return Model(languages, code, weights.astype(np.float32), bias, np.maximum(sure, 1e-3))


def learnable(id: str, language: str) -> Column:
    """Rows that may be learned from: a label, an id, and not held out."""
    return F.col(language).isNotNull() & ~held_out(id) & F.col(id).isNotNull()


def held_out(id: str) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """A model from at most `sample_texts` texts and `sample_bytes` bytes of each language, but one text at least.

    The texts with the least hash of their id are taken. Languages without any n-gram are not learned.
    """
    usable = docs.filter(learnable(id, language)).withColumn(language, F.col(language).cast("string"))
    rows, _ = bounded_sample(usable, language, id, text, sample_texts, sample_bytes)
    return fit([r[2] for r in rows], [r[0] for r in rows])


FIELDS = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ambiguous", T.BooleanType()),
]


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score` (0 to 1) and `ambiguous`.

    Null texts and texts without a letter are `und` with score 0, as is everything if no language was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(column: pa.Array) -> list[pa.Array]:
        known = shared.value
        if not known.languages:
            n = len(column)
            return [pa.array([UNKNOWN] * n), pa.array([0.0] * n), pa.array([True] * n)]
        best, score, ambiguous = known.decode(known.margins(column)[0])
        return [pa.array([known.languages[i] for i in best.tolist()], pa.string()), pa.array(score), pa.array(ambiguous)]

    found = with_arrow_columns(docs, text, FIELDS, compute, SLICE_BYTES // 2)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return (
        found.withColumn("lang_pred", F.when(lettered, F.col("lang_pred")).otherwise(UNKNOWN))
        .withColumn("score", F.when(F.col("lang_pred") == UNKNOWN, 0.0).otherwise(F.col("score")))
        .withColumn("ambiguous", F.col("ambiguous") | (F.col("lang_pred") == UNKNOWN))
    )


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", language: str = "lang", **bounds) -> DataFrame:
    """`docs` with `held_out`, `lang_pred`, `score` and `ambiguous`, after learning from the rows that are not held out."""
    model = train(docs, id, text, language, **bounds)
    return predict(without(docs, ["held_out"]).withColumn("held_out", held_out(id)), model, text)
