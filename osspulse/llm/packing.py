"""Best-fit packing of token sequences by hierarchical residual packing.

Every node of a tree packs what it holds by best fit, largest first, and emits the bins that are
nearly full. Its underfull bins go up as items of their own, several nodes to one parent, where best
fit is repeated, until one node is left or nothing merges any more. A node holds a bounded number of
items (lengths, not tokens), so no task sees all of them.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Mapping
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import Texts, byte_class
from osspulse.llm.common import ship_package, stored, with_arrow_columns, without

CAPACITY = 2048
# Items of one node, and children of one parent.
NODE_ITEMS, FAN_IN = 1 << 16, 16
# Parts of texts with more bytes go to the tokenizer file: the rank file's pattern fails on very long white space.
LONG_PART = 20_000
# First bytes of characters that are white space, or may be.
MAYBE_SPACE = byte_class((0x00, 0x20), (0xC2, 0xC2), (0xE1, 0xE3))
PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(vocabulary: str):
    """The byte-level BPE of a rank file, and the byte length of each of its tokens."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    lengths[list(ranks.values())] = [len(token) for token in ranks]
    named = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return named, lengths


@lru_cache(maxsize=2)
def added_tokens(vocabulary: str) -> dict[bytes, int]:
    """The added tokens of the tokenizer file beside a rank file, which the tokenizer finds inside any text."""
    path = Path(vocabulary).with_suffix(".json")
    found = json.loads(path.read_text())["added_tokens"] if path.exists() else []
    for token in found:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} does not match as it stands")
    return {token["content"].encode(): token["id"] for token in found}


@lru_cache(maxsize=2)
def whole_tokenizer(vocabulary: str):
    """The tokenizer file beside a rank file, to encode a part without added tokens; None if there is no such file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    path = Path(vocabulary).with_suffix(".json")
    return Tokenizer.from_file(str(path)) if path.exists() else None


def encode_part(part: bytes, bpe, vocabulary: str) -> list[int]:
    whole = whole_tokenizer(vocabulary) if len(part) > LONG_PART else None
    return whole.encode(part.decode(), add_special_tokens=False).ids if whole else bpe.encode_ordinary(part.decode())


def token_ids(
    column: pa.Array, vocabulary: str, end_id: int = 0, added: Mapping[bytes, int] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, each text followed by `end_id`, and where each text begins.

    Texts are split at the tokens in `added`, which get their own ids; what lies between is encoded as a text of its own.
    The tokenizer's pattern always begins a new piece before a space that precedes something else
    than white space. So texts are cut there, each different part is encoded once, and the ids are
    copied to all places of that part.
    """
    bpe, lengths = encoding(vocabulary)
    texts = Texts(column)
    data = texts.data
    raw, added = data.tobytes(), added or {}
    either = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True))))
    marks = np.array([m.span() for m in either.finditer(raw)] if added else [], np.int64).reshape(-1, 2)
    heads = np.concatenate((texts.begin[texts.end > texts.begin], marks[~np.isin(marks[:, 1], texts.end), 1]))
    heads = np.setdiff1d(heads, marks[:, 0])
    cut = np.flatnonzero((data[:-1] == 0x20) & ~MAYBE_SPACE[data[1:]])
    cut = cut[~np.isin(cut, heads)]
    if len(marks):
        # No cut inside an added token, nor before a space that one follows: white space ends that part.
        before = np.searchsorted(marks[:, 0], cut, "right") - 1
        inside = (before >= 0) & (cut < marks[before, 1])
        cut = cut[~inside & ~np.isin(cut + 1, marks[:, 0])]
    starts = np.sort(np.concatenate((heads, cut, marks[:, 0])))
    ends = np.minimum(np.append(starts[1:], len(data)), texts.end[np.searchsorted(texts.begin, starts, "right") - 1])
    kind = np.isin(starts, heads) + 2 * np.isin(starts, marks[:, 0])
    # A head may merge with what it is appended to, so heads are encoded alone, and so are long parts.
    seen: dict = {}
    spans = zip(starts.tolist(), ends.tolist(), kind.tolist(), strict=True)
    keys = ((k, raw[i:j]) if k or j - i > LONG_PART else raw[i:j] for i, j, k in spans)
    inverse = np.fromiter((seen.setdefault(key, len(seen)) for key in keys), np.int64, len(starts))
    first = list(seen)
    chosen_head = np.array([isinstance(key, tuple) for key in first], bool)
    spans = [key for key in first if isinstance(key, tuple)]
    alone = [np.asarray([added[x]] if k >= 2 else encode_part(x, bpe, vocabulary), np.uint32) for k, x in spans]
    joined = [key for key in first if not isinstance(key, tuple)]
    together = np.asarray(bpe.encode_to_numpy(b"".join(joined).decode()), np.uint32)
    parts_end = np.cumsum([len(x) for x in joined], dtype=np.int64)
    upto = np.searchsorted(np.cumsum(lengths[together]), parts_end) + 1
    counts, begins = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    counts[~chosen_head], begins[~chosen_head] = np.diff(upto, prepend=0), np.concatenate(([0], upto))[: len(upto)]
    sizes = np.array([len(x) for x in alone], np.int64)
    counts[chosen_head], begins[chosen_head] = sizes, len(together) + np.cumsum(sizes) - sizes
    pool = np.concatenate([together, *alone]) if alone else together
    per = counts[inverse]
    before = np.cumsum(per) - per
    total = int(per.sum())
    flat = pool[np.repeat(begins[inverse] - before, per) + np.arange(total)]
    text_of = np.searchsorted(texts.begin, starts, "right") - 1
    # Empty texts share their place with the next one; searchsorted takes the last, which owns it.
    n_tokens = np.bincount(text_of, per, texts.n).astype(np.int64) if len(starts) else np.zeros(texts.n, np.int64)
    out = np.full(total + texts.n, end_id, np.uint32)
    out[np.arange(total) + np.repeat(np.arange(texts.n), n_tokens)] = flat
    return out, np.concatenate(([0], np.cumsum(n_tokens + 1)))


def cut_pieces(column: pa.Array, vocabulary: str, capacity: int, end_id: int, keep_ids: bool) -> list[pa.Array]:
    ids, first = token_ids(column, vocabulary, end_id, added_tokens(vocabulary))
    raw, rows = memoryview(ids.astype("<u4").tobytes()), []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        short = (end - begin) % capacity or capacity
        bounds = [begin, *range(begin + short, end + 1, capacity)]
        rows.append(
            [
                {
                    "piece": i,
                    "start": a - begin,
                    "length": b - a,
                    "ids_crc32": zlib.crc32(raw[4 * a : 4 * b]),
                    "ids": bytes(raw[4 * a : 4 * b]) if keep_ids else None,
                }
                for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
            ]
        )
    kind = pa.list_(
        pa.struct(
            [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
        )
    )
    return [pa.array(rows, kind)]


def token_pieces(
    docs: DataFrame,
    text: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = 0,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece of at most `capacity` tokens: the other columns of `docs`, piece, start, length, ids_crc32, ids.

    A null or empty text is `end_id` alone. Only longer ones are cut; their first piece takes the rest.
    """
    vocabulary = vocabulary or default_vocabulary()
    cut = partial(cut_pieces, vocabulary=vocabulary, capacity=capacity, end_id=end_id, keep_ids=keep_ids)
    rest = without(docs, ["piece", "start", "length", "ids_crc32", "ids"])
    found = with_arrow_columns(rest, text, [T.StructField("_pieces", PIECES)], cut)
    others = [F.col(f"`{c}`") for c in found.columns if c.lower() not in (text.lower(), "_pieces")]
    return found.select(*others, F.inline("_pieces"))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items in the given order, each to the fullest bin that takes it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n_bins = 0, 0
    bins, offsets = [], []
    for length in lengths.tolist():
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, n_bins = capacity, n_bins, n_bins + 1
        bins.append(chosen)
        offsets.append(capacity - room)
        left = room - length
        if left:
            by_room[left].append(chosen)
            rooms |= 1 << left
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def pack_node(table: pa.Table, level: int, capacity: int) -> pa.Table:
    """The node's items with the bin and offset that best fit gives them, and how full the bin is."""
    table = table.sort_by([("_size", "descending"), ("_item", "ascending")])
    sizes = table.column("_size").to_numpy()
    bins, offsets = best_fit(sizes, capacity)
    fill = np.bincount(bins, sizes).astype(np.int64) if len(bins) else np.zeros(0, np.int64)
    node = table.column("_node")[0].as_py() if table.num_rows else 0
    named = bins + (((level << 24) | node) << 32)
    return (
        table.append_column("_bin", pa.array(named))
        .append_column("_offset", pa.array(offsets))
        .append_column("_fill", pa.array(fill[bins] if len(bins) else fill))
    )


def pack_level(items: DataFrame, level: int, capacity: int) -> DataFrame:
    schema = T.StructType(
        [*items.schema.fields, *(T.StructField(c, T.LongType()) for c in ("_bin", "_offset", "_fill"))]
    )

    def pack_group(table: pa.Table) -> pa.Table:
        return pack_node(table, level, capacity)

    ship_package(items.sparkSession)
    return items.groupBy("_node").applyInArrow(pack_group, schema)


def pack(
    pieces: DataFrame,
    length: str = "length",
    capacity: int = CAPACITY,
    slack: int | None = None,
    node_items: int = NODE_ITEMS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: sequences of at most `capacity`, gapless from 0.

    Rows without a length, or with one outside 1 to `capacity`, get null in both. Repeated rows are
    items of their own; ties go by the row's place in the stored table. `slack`: tokens that a nearly
    full bin may lack (default capacity / 64).
    """
    slack = capacity // 64 if slack is None else slack
    kept = without(pieces, ["sequence_id", "offset"])
    fits = F.col(length).between(1, capacity)
    rows = stored(
        kept.withColumn("_item", F.monotonically_increasing_id()).withColumn(
            "_size", F.when(fits, F.col(length).cast("long"))
        ),
        "pieces",
    )
    items = rows.filter("_size is not null")
    nodes = max(1, -(-items.count() // node_items))
    node = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("long")
    level = 0
    placed = stored(pack_level(items.select("_item", "_size", node("_item", nodes).alias("_node")), 0, capacity), "packed")
    chain: DataFrame | None = None  # first bin, the bin it is in now, its offset there
    current = placed
    while nodes > 1:
        level += 1
        under = current.filter((F.col("_offset") == 0) & (F.col("_fill") < capacity - slack))
        under = under.select(F.col("_bin").alias("_item"), F.col("_fill").alias("_size"), F.col("_node").alias("_child"))
        count = under.count()
        fewer = max(-(-nodes // fan_in), -(-count // node_items), 1)
        if count == 0 or fewer >= nodes:
            break
        up = under.withColumn("_node", F.floor(F.col("_child") * F.lit(fewer) / F.lit(nodes)).cast("long")).drop("_child")
        current = stored(pack_level(up, level, capacity), "merged")
        step = current.select(F.col("_item").alias("_from"), F.col("_bin").alias("_to"), F.col("_offset").alias("_by"))
        if chain is None:
            chain = step
        else:
            later = step.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"), F.col("_by").alias("_more"))
            moved = chain.join(later, "_to", "left").select(
                "_from",
                F.coalesce("_next", "_to").alias("_to"),
                (F.col("_by") + F.coalesce("_more", F.lit(0))).alias("_by"),
            )
            chain = stored(moved, "chain")
        nodes = fewer
    places = placed.select("_item", "_bin", "_offset")
    if chain is not None:
        places = places.join(chain.withColumnRenamed("_from", "_bin"), "_bin", "left").select(
            "_item",
            F.coalesce("_to", "_bin").alias("_bin"),
            (F.col("_offset") + F.coalesce("_by", F.lit(0))).alias("_offset"),
        )
    return (
        rows.join(places, "_item", "left")
        .withColumn("sequence_id", F.col("_bin"))
        .withColumn("offset", F.col("_offset"))
        .drop("_item", "_size", "_bin", "_offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence its token ids as bytes (little-endian, 32 bits each); needs pieces with `ids`."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    whole = packed.filter(F.col("sequence_id").isNotNull())
    return whole.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
