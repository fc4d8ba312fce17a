"""Spelling variants: words one edit apart, found by walking a trie with a frontier of relational states.

Words, read forwards and backwards, form two compressed tries that are kept as one distributed table of edges. A state
(word, position, node) is joined with the edges of its node; the ways that take an edit there go on, level by level, and end as
neighbours where a word ends. An edit always falls on a node, because two words part where the trie
branches. One of the two parts beside an edit is at least half of the word, so states may take their edit
only in the second half of the word in reading direction, where nodes branch little: the tries hold nothing of first halves, and every
word starts at all of its nodes at once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import mix
from osspulse.llm.common import SLICE_BYTES, is_hot, join_hot, map_arrow, sliced, stored, text_column

LEAST_LENGTH, LEAST_COUNT, ONE_IN = 5, 3, 97
# Whole runs that are long enough; a slip only makes them shorter.
RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
# Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
# Nodes from which words are read forwards and backwards.
ROOTS = (1, 2)


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`word` and `n`: the words of all documents that are long and frequent enough. A null id counts as empty, a null text has no words."""
    source = text_column(docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("_id"), F.col(text).alias("_text")), "_text")
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words, n = list(counts), list(counts.values())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in sliced(batch, 1, SLICE_BYTES):
                for key, value in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    # Bytes lower-case A to Z alone.
                    raw = value.as_buffer()
                    runs = RUN.findall(raw.to_pybytes().lower().decode()) if raw else []
                    held.update(runs)
                    # One in 97 words of a document lacks a letter there.
                    start = zlib.crc32(f"{key}:".encode())
                    for word in runs:
                        h = zlib.crc32(word.encode(), start)
                        if h % ONE_IN == 0:
                            at = h % len(word)
                            held[word] -= 1
                            if len(word) > LEAST_LENGTH:
                                held[word[:at] + word[at + 1 :]] += 1
                if len(held) > HELD_WORDS:
                    yield batch_of(held)
                    held = Counter()
        yield batch_of(held)

    counted = map_arrow(source, run, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def prefix_nodes(words: pa.Array, side: int) -> tuple[np.ndarray, ...]:
    """Of every prefix that may stand before an edit: row of the word, length, node and the next two code points (-1 beyond the end).

    Forwards those are prefixes of half a word and longer, backwards those of the other half and longer.
    """
    keys = [word[::-1] for word in words.to_pylist()] if side else words.to_pylist()
    codes = np.frombuffer("".join(keys).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(key) for key in keys], np.int64)
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(keys)), sizes)
    at = np.arange(len(codes)) - first[row] + 1
    node = np.zeros(len(codes), np.uint64)
    state = np.full(len(keys), ROOTS[side], np.uint64)
    alive = np.arange(len(keys))
    for step in range(int(sizes.max()) if len(sizes) else 0):
        alive = alive[sizes[alive] > step]
        place = first[alive] + step
        state[alive] = mix(state[alive] * np.uint64(0x9E3779B97F4A7C15) + codes[place].astype(np.uint64))
        node[place] = state[alive]
    beyond = np.append(codes, [-1, -1])
    next_ = np.where(at < sizes[row], beyond[1:-1], -1)
    after = np.where(at + 1 < sizes[row], beyond[2:], -1)
    kept = at >= (sizes[row] + side) // 2
    return row[kept], at[kept], node[kept].view(np.int64), next_[kept], after[kept]


def bit(code: Column) -> Column:
    """One of 64 bits for a letter."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), code.bitwiseAND(63))


def join_any(big: DataFrame, small: DataFrame, keys: list[str], counts: DataFrame, total: int) -> DataFrame:
    """`join_hot` where `counts` (keys, _n) has a hot key, else one join."""
    hot = counts.filter(is_hot("_n", total)).select(*keys)
    return big.join(small, keys) if hot.isEmpty() else join_hot(big, small, keys, hot)


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The two tries of the second halves of `word` (in reading direction): states, edges and the number of states of each node (node, _n).

    A node is where words end or part and more than one word goes; chains between nodes are single edges. Nodes are 64-bit hashes of prefixes; two that
    clash would only offer words that are not there or are found twice. States: a word (key, read forwards or backwards by `side`; n) at each of
    its nodes, with the position, the next two code points, and whether a word ends there. Edges: node, label, `child` (null if no other
    word goes there), whether a word ends at the child, the bits of the letters that follow it (`nexts`), and the label's first two code points.
    """
    schema = T.StructType.fromDDL("_w long, _at int, node long, _next int, _after int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 0, SLICE_BYTES // 4):
                for side in (0, 1):
                    row, at, node, next_, after = prefix_nodes(part.column(0), side)
                    key = part.column(1).to_numpy()[row] * 2 + side
                    columns = [key, at.astype(np.int32), node, next_.astype(np.int32), after.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    prefixes = stored(map_arrow(words.select("word", "_id"), run, schema), "prefixes")
    least, most = F.min("_next").alias("_least"), F.max("_next").alias("_most")
    nexts = F.bit_or(F.when(F.col("_next") >= 0, bit(F.col("_next"))).otherwise(F.lit(0).cast("long"))).alias("_nexts")
    nodes = prefixes.groupBy("node").agg(least, most, nexts, F.count(F.lit(1)).alias("_n"))
    nodes = nodes.filter("_n > 1 and (_least = -1 or _least <> _most)")
    nodes = stored(nodes.select("node", (F.col("_least") == -1).alias("_end"), "_nexts", "_n"), "nodes")
    cuts = join_any(prefixes, nodes.drop("_n"), ["node"], nodes, prefixes.count())
    onward = Window.partitionBy("_w").orderBy("_at")
    names = ("_at", "node", "_end", "_nexts")
    cuts = cuts.repartition("_w").select("*", *(F.lead(c).over(onward).alias(f"_to{c}") for c in names))
    forwards = words.select(F.col("word").alias("key"), (F.col("_id") * 2).alias("_w"), F.lit(0).alias("side"), "n")
    backwards = words.select(F.reverse("word").alias("key"), (F.col("_id") * 2 + 1).alias("_w"), F.lit(1).alias("side"), "n")
    cuts = stored(cuts.join(forwards.unionByName(backwards), "_w"), "cuts")
    states = cuts.filter("_next >= 0").select("key", "side", "n", F.col("_at").alias("at"), "node", "_next", "_after", "_end")
    size = F.coalesce("_to_at", F.char_length("key")) - F.col("_at")
    edges = cuts.filter("_next >= 0").select(
        "node",
        F.substr(F.col("key"), F.col("_at") + 1, size).alias("label"),
        F.col("_tonode").alias("child"),
        F.coalesce("_to_end", F.lit(True)).alias("end"),
        F.coalesce("_to_nexts", F.lit(0).cast("long")).alias("nexts"),
        F.col("_next").alias("_first"),
        F.when(size > 1, F.col("_after")).alias("_second"),
    )
    # An edge to a child that no other word reaches stands once.
    return states, edges.filter("child is null").unionByName(edges.filter("child is not null").distinct()), nodes.select("node", "_n")


def letter(word: Column, at: Column) -> Column:
    """The code point at this position, 0 where the word ends."""
    return F.ascii(F.substr(word, at + 1, F.lit(1)))


def goes_on(code: Column) -> Column:
    """Whether a word whose next code point is `code` can go on at the child of an edge: a word ends there with it, or an edge begins so."""
    follows = F.col("child").isNotNull() & (F.col("nexts").bitwiseAND(bit(code)) != 0)
    return ((code == 0) & F.col("end")) | ((code != 0) & follows)


def edited(states: DataFrame, edges: DataFrame, counts: DataFrame) -> DataFrame:
    """The states after an edit (key, side, n, near, at, node, _first): `near` is what the whole word must be, `_first` its next code point, 0 at its end."""
    at, key, label, second = F.col("at"), F.col("key"), F.col("label"), F.col("_second")
    l, size = F.char_length("label"), F.char_length("key")  # noqa: E741
    beside = join_any(states.drop("_end"), edges, ["node"], counts, states.count())
    other = (F.col("_next") < F.col("_first")) & (second.isNull() | (second == F.col("_after")))
    less = (F.col("_next") != F.col("_first")) & (F.col("_after") == F.col("_first"))
    before, rest = F.substr(key, F.lit(1), at), F.substr(key, at + 2, size)

    def way(fits: Column, near: Column, code: Column) -> Column:
        to = F.struct(near.alias("near"), (at + l).cast("int").alias("at"), F.col("child").alias("node"), code.alias("_first"))
        return F.when(fits & goes_on(code), to)

    another = other & (second.isNull() | (F.substr(key, at + 2, l - 1) == F.substr(label, F.lit(2), l)))
    ways = F.array(
        way(another, F.concat(before, F.substr(label, F.lit(1), F.lit(1)), rest), letter(key, at + l)),  # another letter
        way(less & F.startswith(rest, label), F.concat(before, rest), letter(key, at + l + 1)),  # a letter less
    )
    # Code points are compared in the join, so that it makes few rows.
    step = beside.filter(other | less).select("key", "side", "n", F.inline(ways)).filter("near is not null")
    # A word without its last letter ends at a node of the word.
    last = states.filter(F.col("_end") & (at == size - 1))
    return step.unionByName(last.select("key", "side", "n", before.alias("near"), "at", "node", F.lit(0).alias("_first")))


def advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after the edge that goes on with the rest of `near`."""
    at, near, l = F.col("at"), F.col("near"), F.char_length("label")  # noqa: E741
    counts = states.groupBy("node", "_first").agg(F.count(F.lit(1)).alias("_n"))
    beside = join_any(states, edges, ["node", "_first"], counts, states.count())
    code = letter(near, at + l)
    fits = beside.filter((F.substr(near, at + 1, l) == F.col("label")) & goes_on(code))
    return fits.select("key", "side", "n", "near", (at + l).cast("int").alias("at"), F.col("child").alias("node"), code.alias("_first"))


def neighbours(words: DataFrame) -> DataFrame:
    """`word`, `n`, `near` and `near_n`: every pair of words that differ by exactly one edit, in one of its orders."""
    states, edges, counts = trie(words)
    edges = stored(edges, "edges")
    step = stored(edited(states, edges, counts), "frontier")
    found = step.filter("_first = 0")
    while not (states := step.filter("_first <> 0")).isEmpty():
        step = stored(advance(states, edges), "frontier")
        found = found.unionByName(step.filter("_first = 0"))
    forwards = lambda c: F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c))
    pairs = found.select(forwards("key").alias("word"), "n", forwards("near").alias("near"))
    return pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """`word` and `root`: where the chain of `word` -> `form` ends. Chains have no loops."""
    current = stored(forms.select("word", F.col("form").alias("to")), "roots")
    while True:
        total = current.count()
        onward = current.select(F.col("word").alias("to"), F.col("to").alias("_next"))
        hot = current.groupBy("to").count().filter(is_hot("count", total)).select("to")
        moved = join_hot(current, onward, ["to"], hot, "left")
        moved = stored(moved.select("word", F.coalesce("_next", "to").alias("to"), F.col("_next").isNotNull().alias("_moved")), "roots")
        current = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return current.select("word", F.col("to").alias("root"))


def group_variants(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of the corpus: word, form, root, n, n_near, form_n, in no order.

    `form` is the near word with the largest `n` (ties: the smallest) if that is at least twice the word's own, else
    null; `root` is where the forms lead. Null and empty texts have no words; repeated rows
    count as often as they stand; a null id counts as an empty one. Without words the result is empty.
    """
    words = stored(word_counts(docs, id, text).withColumn("_id", F.monotonically_increasing_id()), "words")
    strong = lambda n, near_n, near: F.when(near_n >= 2 * n, F.struct((-near_n).alias("_less"), near.alias("near"))).alias("_best")
    word, n, near, near_n = (F.col(c) for c in ("word", "n", "near", "near_n"))
    ways = F.array(F.struct(word, strong(n, near_n, near)), F.struct(near.alias("word"), strong(near_n, n, word)))
    best = neighbours(words).select(F.inline(ways)).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("_best").alias("_best"))
    formed = words.join(best, "word", "left").select(
        "word",
        F.col("_best.near").alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-F.col("_best._less")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    rooted = formed.join(follow(formed.filter("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
