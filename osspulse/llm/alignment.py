"""Two tokenizers' tokens aligned by the bytes they stand for, with corpus-wide counts of the linked pairs.

The first pass aligns all documents and keeps each task's linked id pairs. A minimal perfect hash of the distinct pairs
is built per bucket of their hashes. Tasks then sum their pairs into dense vectors that this hash indexes, the
vectors are added up a tree, and the second pass aligns the documents again and looks the counts
up; a slot's key is compared at every look-up. Where there are more distinct pairs than a task should hold, the
second pass goes over the documents once per shard of the hashes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import byte_class, flatten, mix
from osspulse.llm.common import SLICE_BYTES, map_arrow, ship_package, sliced, stored, text_column, with_arrow_columns, without
from osspulse.llm.packing import encoding

# Keys of one bucket, on average; keys that a task holds at once, with 17 bytes each; vectors that are added at once.
BUCKET_KEYS, SHARD_KEYS, FAN_IN = 1 << 12, 1 << 21, 16
# Distinct pairs that a task of the first pass holds, and parts of texts whose alignment it remembers.
HELD_PAIRS, REMEMBERED = 1 << 20, 300_000
# Longer parts are encoded alone. A byte that no UTF-8 text has.
LONG_PART, CUT = 20_000, 0xFF
# First bytes of characters that are white space, or may be.
MAYBE_SPACE = byte_class((0x00, 0x20), (0xC2, 0xC2), (0xE1, 0xE3))
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
PAIRS = T.StructType([T.StructField(c, T.LongType()) for c in ("pair", "hash", "n")])


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write visible bytes as themselves and the others, in order, as letters from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Aligner:
    """Aligned tokens of texts. What lies between two spaces is aligned once and remembered.

    Both tokenizers end a token before a space that follows something else than a space and precedes
    something else than white space; so texts are cut there, and the parts' alignments are put together.
    A rank file of the first tokenizer's vocabulary beside it is used where it can be, as it is faster.
    """

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        ranks = Path(a).with_suffix(".tiktoken")
        self.ranks = encoding(str(ranks))[0] if ranks.exists() else None
        letters = byte_of_letter()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        a_bytes = [b""] * (max(vocabulary.values()) + 2)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # A piece with a space after something else would span a cut; then texts stay whole.
        self.cuts = not any(b" " in raw.lstrip(b" ") for raw in b_bytes)
        self.raw = [objects(a_bytes), objects(b_bytes)]
        self.lengths = [np.array([len(x) for x in table], np.int64) for table in (a_bytes, b_bytes)]
        # Ids as text, inside a group and at the end of its half.
        self.inner = [objects([f"{i}," for i in range(len(table))]) for table in (a_bytes, b_bytes)]
        self.last = [objects([f"{i}{end}" for i in range(len(table))]) for table, end in ((a_bytes, "|"), (b_bytes, ";"))]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.unwritten: list[tuple] = []
        self.bad: set[int] = set()
        self.sizes = np.zeros((0, 3), np.int64)
        self.links, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def plain(self, part: bytes) -> bool:
        """Whether the part's tokens are the same with others around it; white space at its ends and great length forbid it."""
        return self.ranks is not None and part[-1] != 0x20 and not MAYBE_SPACE[part[0]] and len(part) < LONG_PART

    def encode_first(self, plain: Sequence[bytes], alone: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the first tokenizer for all parts, each with a space before it, and each part's number of ids."""
        ids, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if plain:
            ids = np.asarray(self.ranks.encode_to_numpy((b" " + b" ".join(plain)).decode()), np.int64)
            ends = np.cumsum([len(part) + 1 for part in plain], dtype=np.int64)
            counts = np.diff(np.searchsorted(np.cumsum(self.lengths[0][ids]), ends) + 1, prepend=0)
        found = [x.ids for x in self.a.encode_batch([" " + part.decode() for part in alone], add_special_tokens=False)]
        more = np.fromiter(chain.from_iterable(found), np.int64)
        return np.concatenate((ids, more)), np.concatenate((counts, np.array([len(x) for x in found], np.int64)))

    def learn(self, parts: Sequence[bytes]) -> None:
        """Align parts, each with a space before it; those whose tokens do not give the bytes back are marked."""
        plain, alone = [], []
        for part in parts:
            (plain if self.plain(part) else alone).append(part)
        parts = plain + alone
        first, first_counts = self.encode_first(plain, alone)
        second = self.b.encode([part.decode() for part in parts], num_threads=1)
        flat = [first, np.fromiter(chain.from_iterable(second), np.int64)]
        counts = [first_counts, np.array([len(x) for x in second], np.int64)]
        want = b" " + b" ".join(parts)
        if any(b"".join(raw[x].tolist()) != want for raw, x in zip(self.raw, flat, strict=True)):
            good = []
            each = [np.split(x, np.cumsum(n)[:-1]) for x, n in zip(flat, counts, strict=True)]
            for part, *both in zip(parts, *each, strict=True):
                if all(b"".join(raw[x].tolist()) == b" " + part for raw, x in zip(self.raw, both, strict=True)):
                    good.append(part)
                else:
                    self.bad.add(len(self.groups))
                    self.add([part], np.zeros((1, 3), np.int64), np.zeros(0, np.int64))
            if good:
                self.learn(good)
            return
        ends = [np.cumsum(table[x]) for table, x in zip(self.lengths, flat, strict=True)]
        end_of = np.zeros((2, len(want) + 1), bool)
        for marks, x in zip(end_of, ends, strict=True):
            marks[x] = True
        # Whether a token is the last of its group.
        closing = [marks[x] for marks, x in zip(end_of[::-1], ends, strict=True)]
        part_ends = np.cumsum([len(part) + 1 for part in parts], dtype=np.int64)
        n_groups = np.diff(np.searchsorted(ends[0][closing[0]], part_ends, "right"), prepend=0)
        flat = [x.astype(np.int32) for x in flat]
        self.unwritten.append((len(self.groups), flat, closing, counts[0] + counts[1]))
        links = flat[0][closing[0]].astype(np.int64) << 32 | flat[1][closing[1]]
        self.add(parts, np.stack([counts[0], counts[1], n_groups], axis=1), links)

    def add(self, parts: Sequence[bytes], sizes: np.ndarray, links: np.ndarray) -> None:
        self.known.update(zip(parts, range(len(self.groups), len(self.groups) + len(parts)), strict=True))
        self.groups += [""] * len(parts)
        self.sizes = np.concatenate((self.sizes, sizes))
        self.links = np.concatenate((self.links, links))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes[:, 2])))

    def written_groups(self) -> list[str]:
        """The groups of all known parts as text, which only the second pass needs."""
        for start, flat, closing, counts in self.unwritten:
            at = [np.flatnonzero(x) for x in closing]
            # A group's first ids stand behind all ids of earlier groups, its second ids behind its first ones.
            before = [np.concatenate(([0], x + 1)) for x in at]
            group = [np.cumsum(x) - x for x in closing]
            text = np.empty(len(flat[0]) + len(flat[1]), object)
            for side, place in enumerate((before[1][group[0]], before[0][group[1] + 1])):
                names = self.inner[side][flat[side]]
                names[at[side]] = self.last[side][flat[side][at[side]]]
                text[np.arange(len(names)) + place] = names
            names, upto = text.tolist(), [0, *np.cumsum(counts).tolist()]
            found = ["".join(names[i:j])[:-1] for i, j in zip(upto, upto[1:], strict=False)]
            self.groups[start : start + len(found)] = found
        self.unwritten = []
        return self.groups

    def parts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all parts of the texts, and where each text's begin; a text that cannot be aligned has none."""
        if len(self.known) > REMEMBERED:
            self.forget()
        data, offsets = flatten(column)
        sizes = np.diff(offsets)
        n, full = len(sizes), np.flatnonzero(sizes)
        # One byte before each text that is not empty. Cuts become a byte that no text has.
        begin = offsets[full] + np.arange(len(full))
        joined = np.full(len(data) + len(full) + 1, 0x20, np.uint8)
        own = np.ones(len(joined) - 1, bool)
        own[begin] = False
        joined[:-1][own] = data
        space = joined == 0x20
        if self.cuts and len(data):
            cut = np.flatnonzero(space[1:-1] & ~space[:-2]) + 1
            cut = cut[~MAYBE_SPACE[joined[cut + 1]]]
        else:
            cut = np.zeros(0, np.int64)
        # A text's begin may look like a cut, too.
        marked = np.zeros(len(joined), bool)
        marked[begin] = marked[cut] = True
        starts = np.flatnonzero(marked)
        owner = full[np.searchsorted(begin, starts, "right") - 1] if len(full) else starts
        joined[starts] = CUT
        parts = joined[:-1].tobytes().split(bytes([CUT]))[1:]
        numbers = list(map(self.known.get, parts))
        if None in numbers:
            self.learn(list(dict.fromkeys(part for part, number in zip(parts, numbers, strict=True) if number is None)))
            numbers = list(map(self.known.get, parts))
        numbers = np.array(numbers, np.int64)
        if self.bad:
            bad = np.isin(numbers, np.fromiter(self.bad, np.int64))
            whole = ~np.isin(owner, owner[bad])
            numbers, owner = numbers[whole], owner[whole]
        return numbers, np.searchsorted(owner, np.arange(n + 1))

    def linked(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct parts, the inverse, and the links of the distinct parts with each one's first."""
        each, inverse = np.unique(numbers, return_inverse=True)
        counts = self.sizes[each, 2]
        first = np.concatenate(([0], np.cumsum(counts)))
        at = np.repeat(self.first[each] - first[:-1], counts) + np.arange(first[-1])
        return each, inverse, self.links[at], first


def objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


@lru_cache(maxsize=1)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def sums_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[first[1:]] - sums[first[:-1]]


def hash_of(pairs: np.ndarray) -> np.ndarray:
    return mix(pairs.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def linked_pairs(docs: DataFrame, text: str, a: str, b: str) -> DataFrame:
    """Every task's linked pairs (B id in the low 32 bits), their hashes and how often they occur there."""

    def batch_of(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pairs, counts = merged(held)
        columns = [pairs, hash_of(pairs).view(np.int64), counts]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=PAIRS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = aligner(a, b), [], 0
        for batch in batches:
            for part in sliced(batch, 0, SLICE_BYTES):
                _, inverse, links, first = known.linked(known.parts(part.column(0))[0])
                times = np.repeat(np.bincount(inverse, minlength=len(first) - 1), np.diff(first))
                held.append((links, times))
                size += len(links)
                if size > HELD_PAIRS:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > HELD_PAIRS // 2:
                        yield batch_of(held)
                        held, size = [], 0
        yield batch_of(held)

    return map_arrow(text_column(docs.select(text), text), run, PAIRS)


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.concatenate([np.zeros(0, np.int64), *(p for p, _ in held)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in held)])
    each, inverse = np.unique(pairs, return_inverse=True)
    return each, np.bincount(inverse, counts, len(each)).astype(np.int64)


def level_hash(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix(hashes ^ mix(np.full(1, level + 1, np.uint64)))


@dataclass
class PerfectHash:
    """A slot of its own, gapless from 0, for each of some keys.

    A level is a bit table twice as large as the keys that come to it. Keys that are alone at their place
    set its bit, the others go on to the next level; a key's slot is the number of bits before its own.
    """

    bits: np.ndarray
    sizes: list[int]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """For distinct hashes."""
        tables, sizes, left = [np.zeros(0, bool)], [], hashes
        while len(left):
            size = 2 * len(left) + 1
            place = (level_hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            tables.append(alone)
            sizes.append(size)
            left = left[~alone[place]]
        return cls(np.concatenate(tables), sizes)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slots; any slot, or -1, for hashes that are not among the keys."""
        rank = np.cumsum(self.bits) - 1
        out, left, begin = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            place = begin + (level_hash(hashes[left], level) % np.uint64(size)).astype(np.int64)
            found = self.bits[place]
            out[left[found]] = rank[place[found]]
            left, begin = left[~found], begin + size
        return out


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def bucket_column(bits: int) -> Column:
    return F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")


HASHES = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("keys", T.BinaryType()),
    ]
)
VECTORS = T.StructType(
    [T.StructField("bucket", T.LongType()), T.StructField("part", T.LongType()), T.StructField("counts", T.BinaryType())]
)


def build_bucket(table: pa.Table) -> pa.Table:
    """The perfect hash of a bucket's pairs, and the pairs in the order of their slots."""
    pairs = table.column("pair").to_numpy()
    hashes = hash_of(pairs)
    made = PerfectHash.build(hashes)
    keys = np.zeros(len(pairs), np.int64)
    keys[made.slots(hashes)] = pairs
    columns = [table.column("bucket")[:1].to_pylist(), [np.packbits(made.bits).tobytes()], [made.sizes], [keys.tobytes()]]
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=HASHES.names)


class Shard:
    """The perfect hashes of the buckets from `first` on, their keys, and room for a number per key."""

    def __init__(self, rows: Sequence, bits: int, first: int, n_buckets: int):
        self.bits, self.first, self.n_buckets = bits, first, n_buckets
        self.made: dict[int, PerfectHash] = {}
        sizes = np.zeros(n_buckets, np.int64)
        keys = {}
        for bucket, packed, levels, raw in rows:
            table = np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(levels)).astype(bool)
            self.made[bucket - first] = PerfectHash(table, list(levels))
            keys[bucket - first] = np.frombuffer(raw, np.int64)
            sizes[bucket - first] = len(raw) // 8
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.keys = np.concatenate([np.zeros(0, np.int64), *(keys[i] for i in sorted(keys))])
        self.counts = np.zeros(0, np.int64)
        self.best = np.zeros(0, bool)

    def slots(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs belong here, and their slots. A pair that is not a key is an error."""
        hashes = hash_of(pairs)
        bucket = bucket_of(hashes, self.bits) - self.first
        mine = np.flatnonzero((bucket >= 0) & (bucket < self.n_buckets))
        mine = mine[np.argsort(bucket[mine], kind="stable")]
        bounds = np.searchsorted(bucket[mine], np.arange(self.n_buckets + 1))
        out = np.zeros(len(mine), np.int64)
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            here = slice(bounds[i], bounds[i + 1])
            out[here] = self.starts[i] + self.made[i].slots(hashes[mine[here]]) if i in self.made else -1
        if len(out) and (out.min() < 0 or (self.keys[out] != pairs[mine]).any()):
            raise ValueError("a linked pair of the second pass was not there in the first one; did the documents change?")
        return mine, out


def dense_counts(partials: DataFrame, shard: Shard) -> DataFrame:
    """Per bucket of the shard its vector of counts: a dense vector in each task, added up in a tree."""
    shared = partials.sparkSession.sparkContext.broadcast(shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        dense = np.zeros(len(known.keys), np.int64)
        for batch in batches:
            mine, slots = known.slots(batch.column(0).to_numpy())
            np.add.at(dense, slots, batch.column(2).to_numpy()[mine])
        part, buckets, vectors = TaskContext.get().partitionId(), [], []
        for i in range(known.n_buckets):
            vector = dense[known.starts[i] : known.starts[i + 1]]
            if vector.any():
                buckets.append(i + known.first)
                vectors.append(vector.tobytes())
        columns = [pa.array(buckets, pa.int64()), pa.array([part] * len(buckets), pa.int64()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=VECTORS.names)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("counts"))
        columns = [table.column("bucket")[:1], table.column("part")[:1], pa.array([total.tobytes()], pa.binary())]
        return pa.table(columns, names=VECTORS.names)

    vectors = stored(map_arrow(partials.select("pair", "hash", "n"), run, VECTORS), "vectors")
    ship_package(partials.sparkSession)
    while (vectors.agg(F.max("part")).first()[0] or 0) > 0:
        grouped = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("bucket", "part")
        vectors = stored(grouped.applyInArrow(add, VECTORS), "vectors")
    return vectors


def best_counts(shards: Sequence[Shard]) -> np.ndarray:
    """Per B id the highest count of its pairs; its size is bounded by the vocabulary."""
    highest = np.zeros(0, np.int64)
    for shard in shards:
        ids = shard.keys & 0xFFFFFFFF
        if len(ids):
            highest = np.pad(highest, (0, max(0, int(ids.max()) + 1 - len(highest))))
            np.maximum.at(highest, ids, shard.counts)
    return highest


def count_pairs(docs: DataFrame, text: str, a: str, b: str, shard_keys: int = SHARD_KEYS) -> list:
    """The first pass and the counts: broadcast shards, each with the counts of its keys."""
    spark = docs.sparkSession
    partials = stored(linked_pairs(docs, text, a, b), "pairs")
    keys = stored(partials.select("pair", "hash").distinct(), "keys")
    total = keys.count()
    bits = max(0, int(np.ceil(np.log2(max(1, total) / BUCKET_KEYS))))
    split = min(bits, max(0, int(np.ceil(np.log2(max(1, total) / shard_keys)))))
    ship_package(spark)
    built = keys.select("pair", bucket_column(bits).alias("bucket")).groupBy("bucket").applyInArrow(build_bucket, HASHES)
    built, per = stored(built, "hashes"), 1 << (bits - split)
    counted = []
    for i in range(1 << split):
        inside = F.col("bucket").between(i * per, (i + 1) * per - 1)
        # Bounded by the keys of a shard.
        shard = Shard(built.filter(inside).collect(), bits, i * per, per)
        mine = partials.filter(bucket_column(bits).between(i * per, (i + 1) * per - 1))
        shard.counts = np.zeros(len(shard.keys), np.int64)
        for bucket, counts in dense_counts(mine, shard).select("bucket", "counts").toLocalIterator():
            at = shard.starts[bucket - shard.first]
            shard.counts[at : at + len(counts) // 8] = np.frombuffer(counts, np.int64)
        highest = best_counts([shard])
        counted.append((spark.sparkContext.broadcast(shard), highest))
        del shard
    size = max(len(h) for _, h in counted)
    best = np.max([np.pad(h, (0, size - len(h))) for _, h in counted], axis=0)
    return [(shard, spark.sparkContext.broadcast(best)) for shard, _ in counted]


def align(
    docs: DataFrame, text: str = "text", a: str | None = None, b: str | None = None, shard_keys: int = SHARD_KEYS
) -> DataFrame:
    """`docs` with n_a, n_b, n_groups, n_links, n_best, count_sum (over links) and `groups`: `a1,a2|b1;a3|b2,b3`.

    Texts that are null, empty, or that one of the tokenizers does not give back to the byte have zeros and ''.
    Repeated rows count as often as they stand. `a`: a byte-level tokenizer file, which gets a space before
    the text; `b`: a sentence-piece model, which adds that space itself.
    """
    first, second = default_tokenizers()
    a, b = a or first, b or second
    rest = without(docs, [*COUNTS, "groups", "_best", "_sum"])
    shards = count_pairs(rest, text, a, b, shard_keys)

    def look_up(known: Aligner, numbers: np.ndarray, first: np.ndarray, shard: Shard, best: np.ndarray) -> list[np.ndarray]:
        _, inverse, links, begins = known.linked(numbers)
        mine, slots = shard.slots(links)
        counts, is_best = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
        counts[mine] = shard.counts[slots]
        is_best[mine] = counts[mine] == best[links[mine] & 0xFFFFFFFF]
        return [sums_of(sums_of(x, begins)[inverse], first) for x in (is_best, counts)]

    partial = [T.StructField(c, T.LongType()) for c in ("_best", "_sum")]
    for shard, best in shards[:-1]:

        def add(column: pa.Array, shard=shard, best=best) -> list[pa.Array]:
            known = aligner(a, b)
            numbers, first = known.parts(column)
            return [pa.array(x) for x in look_up(known, numbers, first, shard.value, best.value)]

        before = [F.coalesce(F.col(c), F.lit(0)) for c in ("_best", "_sum") if c in rest.columns] or [F.lit(0), F.lit(0)]
        kept = rest.withColumns({"_best0": before[0], "_sum0": before[1]})
        added = with_arrow_columns(kept, text, partial, add)
        added = added.withColumns({"_best": F.col("_best") + F.col("_best0"), "_sum": F.col("_sum") + F.col("_sum0")})
        rest = stored(added.drop("_best0", "_sum0"), "aligned")
    earlier = [F.col(c) if c in rest.columns else F.lit(0) for c in ("_best", "_sum")]
    rest = rest.withColumns({"_best": earlier[0].cast("long"), "_sum": earlier[1].cast("long")})
    shard, best = shards[-1]

    def compute(column: pa.Array) -> list[pa.Array]:
        known = aligner(a, b)
        numbers, first = known.parts(column)
        each, inverse = np.unique(numbers, return_inverse=True)
        sizes = known.sizes[each][inverse]
        n_a, n_b, n_groups = (sums_of(sizes[:, k], first) for k in range(3))
        n_best, count_sum = look_up(known, numbers, first, shard.value, best.value)
        written = known.written_groups()
        names, at = [written[i] for i in numbers.tolist()], first.tolist()
        groups = [";".join(names[i:j]) for i, j in zip(at, at[1:], strict=False)]
        return [*(pa.array(x) for x in (n_a, n_b, n_groups, n_groups, n_best, count_sum)), pa.array(groups, pa.string())]

    fields = [*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("groups", T.StringType())]
    found = with_arrow_columns(rest, text, fields, compute)
    sums = {"n_best": F.col("n_best") + F.col("_best"), "count_sum": F.col("count_sum") + F.col("_sum")}
    return found.withColumns(sums).drop("_best", "_sum")
