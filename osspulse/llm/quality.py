"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

Trees are grown on binned features of a bounded sample of labelled texts and flattened into arrays of nodes, by
which all rows of a batch walk down at once. A higher share of symbols, repeated lines or
repeated words can only lower the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import NEWLINE, VISIBLE, Texts, byte_class, numbered, paired, segment_sums
from osspulse.llm.common import with_arrow_columns, without

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
NOT_CONTINUATION = ~byte_class((0x80, 0xBF))
UPPER, DIGITS = byte_class((0x41, 0x5A)), byte_class((0x30, 0x39))
STOPS = np.isin(np.arange(256), list(b".!?"))
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OTHERS = ("_lines", "_upper", "_digits", "_stops", "_distinct")
# Features and the direction that is allowed: 0 any, -1 may only lower the score.
FEATURES = {
    "words": 0,
    "word_length": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "words_a_line": 0,
    "upper": 0,
    "digits": 0,
    "stops": 0,
    "distinct": 0,
}
SAMPLE_TEXTS = 8000
BINS, TREES, DEPTH, RATE, PENALTY, LEAST_ROWS = 32, 40, 3, 0.2, 1.0, 8


def again(keys: np.ndarray) -> np.ndarray:
    """Whether a key has occurred before, and how often each occurs in all: two arrays."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(keys)))
    later, count = np.empty(len(keys), bool), np.empty(len(keys), np.int64)
    later[order] = ~new
    count[order] = np.repeat(sizes, sizes)
    return later, count


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts for each text; null counts as empty."""
    texts = Texts(column)
    data = texts.data
    starts, ends = texts.spans(VISIBLE)
    first = texts.first_of(starts)
    n_words = np.diff(first)
    text_of = np.repeat(np.arange(texts.n), n_words)
    words, _ = numbered(data, starts, ends)
    # Numbers below those of all spans, so that a pair fits an integer.
    own = paired(text_of, words)
    out = {"n_words": n_words, "word_chars": texts.total(VISIBLE & NOT_CONTINUATION), "n_symbols": texts.total(SYMBOLS)}

    a, b = texts.spans(~byte_class((NEWLINE, NEWLINE)))
    words_before = np.searchsorted(starts, a)
    full = np.searchsorted(starts, b) > words_before
    a, b = a[full], b[full]
    line_of = np.searchsorted(texts.begin, a, "right") - 1
    later, _ = again(paired(line_of, numbered(data, a, b)[0]))
    out["n_dup_lines"] = np.bincount(line_of[later], minlength=texts.n).astype(np.int64)
    out["_lines"] = np.bincount(line_of, minlength=texts.n).astype(np.int64)

    windows = np.flatnonzero(text_of[2:] == text_of[:-2]) if len(starts) > 2 else np.zeros(0, np.int64)
    _, count = again(paired(paired(own[windows], words[windows + 1]), words[windows + 2]))
    found = windows[count > 1]
    covered = np.zeros(len(starts), bool)
    for step in range(3):
        covered[found + step] = True
    out["n_repeat_words"] = segment_sums(covered, first)
    out["_distinct"] = n_words - segment_sums(again(own)[0], first)
    out |= {"_upper": texts.total(UPPER), "_digits": texts.total(DIGITS), "_stops": texts.total(STOPS)}
    return out


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words, chars, lines = (np.maximum(s[k], 1).astype(float) for k in ("n_words", "word_chars", "_lines"))
    return np.stack(
        [
            np.log1p(s["n_words"]),
            s["word_chars"] / words,
            s["n_symbols"] / chars,
            s["n_dup_lines"] / lines,
            s["n_repeat_words"] / words,
            s["n_words"] / lines,
            s["_upper"] / chars,
            s["_digits"] / chars,
            s["_stops"] / words,
            s["_distinct"] / words,
        ],
        axis=1,
    )


@dataclass
class Trees:
    """Complete binary trees: node i of a tree has the children 2i + 1 and 2i + 2; values are at the leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def grow_tree(binned: np.ndarray, edges: list[np.ndarray], pull: np.ndarray, weight: np.ndarray, directions: list[int]):
    """One tree on gradients: arrays of features, thresholds and values."""
    nodes = (1 << DEPTH + 1) - 1
    feature, threshold = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
    value, bounds = np.zeros(nodes), np.tile([-np.inf, np.inf], (nodes, 1))
    at = np.zeros(len(pull), np.int64)
    best = lambda g, h: g / (h + PENALTY)
    value[0] = best(pull.sum(), weight.sum())
    for node in range((1 << DEPTH) - 1):
        value[2 * node + 1] = value[2 * node + 2] = value[node]
        bounds[2 * node + 1] = bounds[2 * node + 2] = bounds[node]
        rows = np.flatnonzero(at == node)
        choice = None
        g, h = pull[rows], weight[rows]
        for f, direction in enumerate(directions if len(rows) >= 2 * LEAST_ROWS else []):
            cut = np.array([np.bincount(binned[rows, f], x, BINS).cumsum() for x in (g, h, np.ones(len(rows)))])[:, :-1]
            left = np.clip(best(cut[0], cut[1]), *bounds[node])
            right = np.clip(best(g.sum() - cut[0], h.sum() - cut[1]), *bounds[node])
            ok = (cut[2] >= LEAST_ROWS) & (len(rows) - cut[2] >= LEAST_ROWS) & (direction * (right - left) >= 0)
            gain = sum(
                2 * v * gg - v * v * (hh + PENALTY)
                for v, gg, hh in ((left, cut[0], cut[1]), (right, g.sum() - cut[0], h.sum() - cut[1]))
            )
            gain = np.where(ok, gain - g.sum() ** 2 / (h.sum() + PENALTY), -np.inf)
            k = int(gain.argmax())
            if k < len(edges[f]) and gain[k] > 1e-6 and (choice is None or gain[k] > choice[0]):
                choice = gain[k], f, k, left[k], right[k]
        if choice is not None:
            _, f, k, low, high = choice
            feature[node], threshold[node] = f, edges[f][k]
            value[2 * node + 1], value[2 * node + 2] = low, high
            if directions[f] < 0:
                middle = (low + high) / 2
                bounds[2 * node + 1, 0], bounds[2 * node + 2, 1] = middle, middle
        at[rows] = 2 * node + 1 + ((binned[rows, feature[node]] > choice[2]) if choice is not None else 0)
    return feature, threshold, value * RATE


def fit(x: np.ndarray, y: np.ndarray) -> Trees | None:
    """Trees for y in {0, 1}; None without both classes."""
    if not len(y) or y.min() == y.max():
        return None
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    margin, grown = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        tree = grow_tree(binned, edges, y - p, p * (1 - p), list(FEATURES.values()))
        grown.append(tree)
        margin += Trees(*(np.array([part]) for part in tree), 0.0).margin(x)
    return Trees(*(np.stack(part) for part in zip(*grown, strict=True)), base)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    names = (*STATISTICS, *OTHERS)

    def compute(column: pa.Array) -> list[pa.Array]:
        found = statistics(column)
        return [pa.array(found[name]) for name in names]

    return with_arrow_columns(docs, text, [T.StructField(name, T.LongType()) for name in names], compute)


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE_TEXTS
) -> Trees | None:
    """Trees from at most `sample` labelled texts, those with the least hash of the id.

    A document with several labels counts by their mean; null labels and ids teach nothing.
    """
    known = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(id).agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64(id), id).limit(sample)
    texts = docs.select(F.col(id), F.col(text).alias("_text")).join(F.broadcast(chosen), id)
    columns = (*STATISTICS, *OTHERS)
    rows = with_statistics(texts, "_text").select("_label", *columns).orderBy(F.xxhash64(id)).limit(sample).toPandas()
    return fit(features({c: rows[c].to_numpy() for c in columns}), rows["_label"].to_numpy())


def rate(docs: DataFrame, model: Trees | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """`docs` with the statistics, `base_failed`, `quality_score` and `kept`.

    Null texts have no words, and so fail. Without a model the base rules alone decide (score null).
    """
    own = [*STATISTICS, "quality_score", "base_failed", "kept"]
    fields = [T.StructField(c, T.LongType()) for c in STATISTICS] + [T.StructField("quality_score", T.DoubleType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(column: pa.Array) -> list[pa.Array]:
        found = statistics(column)
        score = pa.nulls(len(column), pa.float64()) if shared.value is None else pa.array(shared.value.score(features(found)))
        return [*(pa.array(found[c]) for c in STATISTICS), score]

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = ~F.col("base_failed") & F.coalesce(F.col("quality_score") >= least, F.lit(True))
    found = with_arrow_columns(without(docs, own), text, fields, compute)
    return found.withColumn("base_failed", failed).withColumn("kept", good)
