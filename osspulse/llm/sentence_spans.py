"""Substring dedup over sliding spans of sentences.

Texts are cut into sentences; long ones are cut further at places that their words alone decide, so that
a passage falls into the same parts wherever it begins. Every sentence begins a span: the shortest run of at least `least_sentences`
sentences and `least_words` words. Spans are hashed and joined globally; sentences inside a span that
has occurred before, in the order of ids and places, are removed.

Any WINDOW words in a row hold a cut, at a mark or else the word of least hash, so all cuts between the
first and the last WINDOW words of a passage are the same wherever it stands; and every sentence also ends a span, the
shortest one backwards. A repeated passage of n words so loses at least n + 1 - 2 * WINDOW of them, if these hold a
span: always from 51 words on.

Few spans are repeated. So the bare hashes are shuffled and counted first, the repeated ones become a bit table, and only spans that it
lets through are shuffled with the ids and places that the join needs.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import VISIBLE, Texts, byte_class, mix, span_hashes
from osspulse.llm.common import SLICE_BYTES, is_hot, map_arrow, sliced, stored, text_key, with_arrow_columns, without

LEAST_SENTENCES, LEAST_WORDS = 3, 20
# Bits of the table of repeated spans for each of them, and of the whole table: 64 MB. Beyond that all spans are joined.
BITS_EACH, MOST_BITS = 16, 1 << 29
# Words in a row of which one ends a sentence.
WINDOW = 10
ENDS_SENTENCE = byte_class((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("_h1", T.LongType()),
            T.StructField("_h2", T.IntegerType()),
            T.StructField("_at", T.IntegerType()),
            T.StructField("_n", T.IntegerType()),
        ]
    )
)


def least_of_windows(hashes: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Whether each word has the least hash, the last of equals, of some WINDOW words in a row of its text."""
    found = np.zeros(len(hashes), bool)
    if len(hashes) >= WINDOW:
        windows = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
        least = np.arange(len(windows)) + WINDOW - 1 - windows[:, ::-1].argmin(axis=1)
        found[least[text_of[: len(windows)] == text_of[WINDOW - 1 :]]] = True
    return found


class Sentences:
    """Sentences of a column of texts: a text's words up to a mark, a line break or a cut.

    Sentence i has words [word_first[i], word_first[i + 1]); text t has sentences [first[t], first[t + 1]).
    """

    def __init__(self, column: pa.Array):
        self.texts = texts = Texts(column)
        self.starts, self.ends = texts.spans(VISIBLE)
        n = len(self.starts)
        words = texts.first_of(self.starts)
        breaks = np.concatenate(([0], np.cumsum(texts.data == 10)))
        # A word ends its sentence if it ends with a mark, or if a line break or the text's end follows.
        follows = np.append(self.starts[1:], len(texts.data))
        marked = ENDS_SENTENCE[texts.data[self.ends - 1]]
        last = marked | (breaks[follows] > breaks[self.ends])
        last[words[1:][words[1:] > words[:-1]] - 1] = True
        hashes = span_hashes(texts.data, self.starts, self.ends)
        # Marks come first, so windows that hold one need no other cut.
        hashes[marked] = 0
        last |= least_of_windows(hashes, np.repeat(np.arange(texts.n), np.diff(words)))
        begins = np.ones(n, bool)
        begins[1:] = last[:-1]
        self.word_first = np.append(np.flatnonzero(begins), n)
        self.first = np.searchsorted(self.word_first[:-1], words)

    def hashes(self) -> np.ndarray:
        """A hash per sentence of its words with single spaces between."""
        data, starts, ends = self.texts.data, self.starts, self.ends
        keep = VISIBLE[data]
        keep[ends] = True
        data = np.where(keep & ~VISIBLE[data], np.uint8(0x20), data)
        place = np.cumsum(keep) - 1
        raw, digest = data[keep].tobytes(), xxhash.xxh3_64_intdigest
        a, b = place[starts[self.word_first[:-1]]], place[ends[self.word_first[1:] - 1]]
        spans = zip(a.tolist(), b.tolist(), strict=True)
        return np.fromiter((digest(raw[i:j]) for i, j in spans), np.uint64, len(a))


def sentence_spans(column: pa.Array, least_sentences: int, least_words: int) -> list[pa.Array]:
    """For each text its spans: two hashes, first sentence, number of sentences."""
    found = Sentences(column)
    hashes, words = found.hashes(), found.word_first
    n = len(hashes)
    # Sums with a multiplier make a span's hash from its sentences' hashes in order.
    reach = np.maximum(
        np.arange(n) + least_sentences, np.searchsorted(words, words[:-1] + least_words, "left")
    )
    text_of = np.repeat(np.arange(len(column)), np.diff(found.first))
    at = np.flatnonzero(reach <= found.first[1:][text_of] if n else np.zeros(0, bool))
    size = reach[at] - at
    if n:
        upto = np.arange(1, n + 1)
        back = np.minimum(upto - least_sentences, np.searchsorted(words, words[1:] - least_words, "right") - 1)
        whole = back >= found.first[:-1][text_of]
        both = np.unique(np.concatenate((at * (n + 1) + reach[at], back[whole] * (n + 1) + upto[whole])))
        at, size = both // (n + 1), both % (n + 1) - both // (n + 1)
    h1, h2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    other = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    for step in range(int(size.max()) if len(size) else 0):
        use = np.flatnonzero(size > step)
        h1[use] = mix(h1[use] * np.uint64(0x9E3779B97F4A7C15) + hashes[at[use] + step])
        h2[use] = mix(h2[use] * np.uint64(0xC2B2AE3D27D4EB4F) + other[at[use] + step])
    starts = found.first[:-1][text_of[at]] if n else at
    struct = pa.StructArray.from_arrays(
        [
            pa.array(h1.view(np.int64)),
            pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
            pa.array((at - starts).astype(np.int32)),
            pa.array(size.astype(np.int32)),
        ],
        ["_h1", "_h2", "_at", "_n"],
    )
    offsets = np.searchsorted(text_of[at], np.arange(len(column) + 1)) if n else np.zeros(len(column) + 1)
    return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), struct)]


def cut_sentences(texts: pa.Array, removed: pa.Array) -> list[pa.Array]:
    """Texts without the sentences in `removed` (runs of first and number), and the numbers of both."""
    found = Sentences(texts)
    rows, n_removed = [], []
    words = found.word_first
    for i, (text, runs) in enumerate(zip(texts, removed, strict=True)):
        n = int(found.first[i + 1] - found.first[i])
        gone = np.zeros(n, bool)
        for run in runs.as_py() or ():
            gone[run["_at"] : run["_at"] + run["_n"]] = True
        n_removed.append(int(gone.sum()))
        if not gone.any():
            rows.append(text.as_py())
            continue
        # A sentence reaches from its first word to the next sentence's; the first one from the text's start.
        bounds = found.starts[words[found.first[i] : found.first[i + 1]]]
        bounds = np.append(bounds, found.texts.end[i])
        bounds[0] = found.texts.begin[i]
        kept = [found.texts.data[a:b].tobytes() for a, b, g in zip(bounds, bounds[1:], gone, strict=False) if not g]
        rows.append(b"".join(kept).decode())
    return [pa.array(rows, pa.string()), pa.array(np.diff(found.first).astype(np.int64)), pa.array(n_removed, pa.int64())]


def bit_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return hashes & (bits - 1), (hashes >> 34) & (bits - 1)


def maybe_repeated(spans: DataFrame, bits_each: int = BITS_EACH, most_bits: int = MOST_BITS) -> DataFrame:
    """All rows of `spans` whose first hash occurs more than once, and one or two in a hundred of the others."""
    counted = spans.groupBy("_h1").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    repeated = stored(counted.select("_h1"), "hashes")
    bits = 1 << max(18, (bits_each * repeated.count()).bit_length())
    if bits > most_bits:
        return spans
    both = F.array(F.col("_h1").bitwiseAND(bits - 1), F.shiftright("_h1", 34).bitwiseAND(bits - 1))
    places = repeated.select(F.explode(both).alias("_place"))
    parts = places.groupBy(F.shiftright("_place", 15).alias("_part")).agg(
        F.bitmap_construct_agg(F.col("_place").bitwiseAND((1 << 15) - 1)).alias("_bits")
    )
    table = np.zeros(bits >> 3, np.uint8)
    for row in parts.toLocalIterator():
        table[row["_part"] << 12 : row["_part"] + 1 << 12] = np.frombuffer(row["_bits"], np.uint8)
    shared = spans.sparkSession.sparkContext.broadcast(table)
    at = spans.columns.index("_h1")

    def run(batches):
        for batch in batches:
            hashes, found = batch.column(at).to_numpy(), np.ones(batch.num_rows, bool)
            for place in bit_places(hashes, bits):
                found &= (shared.value[place >> 3] >> (place & 7) & 1).astype(bool)
            yield batch.filter(pa.array(found))

    return stored(map_arrow(spans, run, spans.schema), "likely")


class HotFirsts:
    """Of hashes that a fixed share of all spans has, so few, the place of the first span."""

    def __init__(self, rows: list, order: list[str]):
        once = Counter(row["_h1"] for row in rows)
        rows = sorted((row for row in rows if once[row["_h1"]] == 1), key=lambda row: row["_h1"])
        self.h1, self.h2 = (np.array([row[c] for row in rows], np.int64) for c in ("_h1", "_h2"))
        self.at = np.array([row["_first"]["_at"] for row in rows], np.int64)
        self.order = [[row["_first"][c] for row in rows] for c in order]

    def state(self, h1: np.ndarray, h2: np.ndarray, at: np.ndarray, order: list[pa.Array]) -> np.ndarray:
        """0 for spans with other hashes, 1 for the first span of a hash that is here, 2 for its later ones."""
        if not len(self.h1):
            return np.zeros(len(h1), np.int32)
        i = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        out = np.where((self.h1[i] == h1) & (self.h2[i] == h2), 2, 0).astype(np.int32)
        for row in np.flatnonzero((out > 0) & (self.at[i] == at)).tolist():
            if all(column[row].as_py() == first[i[row]] for column, first in zip(order, self.order, strict=True)):
                out[row] = 1
        return out


def repeated_spans(spans: DataFrame, order: list[str]) -> DataFrame:
    """The rows of `spans` that are not the first with their hash, in the order of these columns and `_at`.

    Spans of hot hashes stay where they are and are compared there with the first one.
    """
    keys = ["_h1", "_h2"]
    first = F.min(F.struct(*order, "_at")).alias("_first")
    groups = spans.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    groups = stored(groups, "repeated")
    # At most one over the share that makes a hash hot.
    hot = HotFirsts(groups.filter(is_hot("_times", spans.count())).collect(), order)
    shared, names = spans.sparkSession.sparkContext.broadcast(hot), spans.columns
    at = [names.index(c) for c in (*keys, "_at", *order)]
    schema = T.StructType([*spans.schema.fields, T.StructField("_state", T.IntegerType())])

    def run(batches):
        for batch in batches:
            h1, h2, place = (batch.column(i).to_numpy().astype(np.int64) for i in at[:3])
            state = shared.value.state(h1, h2, place, [batch.column(i) for i in at[3:]])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(state)], names=schema.names)

    told = map_arrow(spans, run, schema)
    often = told.filter("_state = 2").drop("_state")
    rest = told.filter("_state = 0").drop("_state").join(groups.drop("_times"), keys)
    return often.unionByName(rest.filter(~F.struct(*order, "_at").eqNullSafe(F.col("_first"))).drop("_first"))


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_sentences: int = LEAST_SENTENCES,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """`docs` with repeated spans cut from the text, and `n_sentences`, `n_removed`, `removed_spans`.

    The first occurrence, by id (nulls first), then by hash of the text and place, keeps its
    sentences. Rows with the same id and text are one document and get the same result. Null stays null;
    a text without repeated spans is unchanged to the byte.
    """
    kept = without(docs, ["n_sentences", "n_removed", "removed_spans"])
    source = kept.select(F.col(id).alias("_id"), F.col(text).alias("_text")).filter("_text is not null")
    # Told apart among rows of one id, so one hash of the text will do.
    key = ["_id", "_k1"]
    compute = partial(sentence_spans, least_sentences=least_sentences, least_words=least_words)
    spanned = with_arrow_columns(
        source.select("_id", text_key("_text")[0], "_text"), "_text", [T.StructField("_spans", SPANS)], compute
    )
    spans = stored(spanned.drop("_text").select(*key, F.inline("_spans")), "spans")
    again = repeated_spans(maybe_repeated(spans), key)
    runs = again.groupBy(*key).agg(F.collect_set(F.struct("_at", "_n")).alias("removed_spans"))
    keyed = kept.select("*", text_key(text)[0]).alias("d")
    same = F.col(f"d.{id}").eqNullSafe(F.col("r._id")) & (F.col("d._k1") == F.col("r._k1"))
    joined = keyed.join(runs.alias("r"), same, "left").select(
        *(F.col(f"d.`{c}`") for c in kept.columns), F.array_sort("r.removed_spans").alias("removed_spans")
    )
    return cut_texts(joined, text)


def cut_texts(joined: DataFrame, text: str) -> DataFrame:
    at, runs = joined.columns.index(text), joined.columns.index("removed_spans")
    numbers = [T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())]
    schema = T.StructType([*joined.schema.fields, *numbers])

    def run(batches):
        for batch in batches:
            for part in sliced(batch, at, SLICE_BYTES):
                columns = list(part.columns)
                columns[at], n, removed = cut_sentences(part.column(at), part.column(runs))
                yield pa.RecordBatch.from_arrays([*columns, n, removed], names=schema.names)

    return map_arrow(joined, run, schema)
