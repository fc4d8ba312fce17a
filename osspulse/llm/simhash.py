"""SimHash near-duplicates found through a hierarchical index in Gray order.

Fingerprints that share a masked bit pattern hang below one node, and the pattern is kept there once.
If two of them differ in at most d bits and the free bits are cut into d + 1 parts, they agree in one
part; so each fingerprint goes below one node per part, and every link shows below some node. A node
with too many fingerprints hands them down: the rest of the bits is cut again. Below a node they
are in order of their Gray rank, in which neighbours share most bits: runs of them form leaves and runs of
leaves form branches, each with the bits all members share. Two groups are compared only if the bits
that both share differ in no more places than allowed, and not if they are connected already.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import VISIBLE, Texts, mix
from osspulse.llm.common import is_hot, join_hot, map_arrow, stored, text_key, with_arrow_columns
from osspulse.llm.components import connected_components

LANES = np.uint64(0x0101010101010101)
# A node hands down more fingerprints than this. Nodes with few free bits can't have many.
NODE_ROWS, FEW_FREE_BITS = 4096, 16
# Groups of up to SMALL are compared directly; a leaf has LEAF fingerprints, a branch LEAF leaves.
SMALL, LEAF = 16, 16
ROUTED = T.StructType([T.StructField(c, T.LongType()) for c in ("kind", "key", "mask", "fp", "rank", "other")])
LINK, HANDED_DOWN = 0, 1


def shingle_hashes(column: pa.Array, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each run of `words` words, joined by spaces, and the number of runs of each text."""
    texts = Texts(column, lower=True)
    starts, ends = texts.spans(VISIBLE)
    keep = VISIBLE[texts.data]
    keep[ends] = True
    texts.data[ends] = 0x20
    place = np.cumsum(keep) - 1
    raw, begin, end = texts.data[keep].tobytes(), place[starts], place[ends]
    first = texts.first_of(starts)
    n_words = np.diff(first)
    runs = np.where(n_words == 0, 0, np.maximum(1, n_words - words + 1))
    at = np.repeat(first[:-1] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    upto = np.minimum(at + words, np.repeat(first[1:], runs)) - 1
    digest, spans = xxhash.xxh64_intdigest, zip(begin[at].tolist(), end[upto].tolist(), strict=True)
    return np.fromiter((digest(raw[a:b], seed) for a, b in spans), np.uint64, len(at)), runs


def majority_bits(hashes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Per text the bits set in more than half of its hashes; zero without any."""
    out = np.zeros(len(runs), np.uint64)
    full = np.flatnonzero(runs)
    if not len(full):
        return out
    first = (np.cumsum(runs) - runs)[full]
    # One byte counts up to 255 hashes, so longer texts are summed in parts.
    parts = -(-runs[full] // 255)
    part_first = np.cumsum(parts) - parts
    cuts = np.repeat(first, parts) + 255 * (np.arange(parts.sum()) - np.repeat(part_first, parts))
    for lane in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(lane)) & LANES, cuts)
        counts = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), part_first, axis=0)
        for byte in range(8):
            is_set = 2 * counts[:, byte] > runs[full]
            out[full] |= is_set.astype(np.uint64) << np.uint64(8 * byte + lane)
    return out


def fingerprint_column(column: pa.Array, words: int, seed: int) -> list[pa.Array]:
    return [pa.array(majority_bits(*shingle_hashes(column, words, seed)).view(np.int64))]


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """`docs` with `fingerprint`, a 64-bit integer. Null texts and texts without words get 0."""
    compute = partial(fingerprint_column, words=words, seed=seed)
    return with_arrow_columns(docs, text, [T.StructField("fingerprint", T.LongType())], compute)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def parts_of(mask: int, distance: int) -> list[int]:
    """The bits outside `mask` as `distance` + 1 patterns of neighbouring bits."""
    free = [bit for bit in range(63, -1, -1) if not mask >> bit & 1]
    return [sum(1 << int(bit) for bit in part) for part in np.array_split(free, distance + 1) if len(part)]


def hand_down(fps: np.ndarray, key: int, mask: int, distance: int) -> dict[str, np.ndarray]:
    """The fingerprints once for each node below `key`, with their Gray rank among the free bits."""
    out: dict[str, list] = {"key": [], "mask": [], "fp": [], "rank": []}
    for part in parts_of(mask, distance):
        fixed = mask | part
        below = mix((fps & np.uint64(part)) ^ mix(np.full(1, (key ^ part) & (2**64 - 1), np.uint64)))
        ranks = gray_rank(fps & np.uint64(~fixed & (2**64 - 1))) ^ np.uint64(1 << 63)
        for name, values in (("key", below), ("mask", np.full(len(fps), fixed, np.uint64)), ("fp", fps), ("rank", ranks)):
            out[name].append(values)
    return {name: np.concatenate(values) for name, values in out.items()}


def record_batch(kind: int, n: int, **columns: np.ndarray) -> pa.RecordBatch:
    zero = np.zeros(n, np.int64)
    arrays = [np.full(n, kind, np.int64) if f == "kind" else columns.get(f, zero).view(np.int64) for f in ROUTED.names]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=ROUTED.names)


class Forest:
    """Sets that are joined; `labels` names the set of each element."""

    def __init__(self, n: int):
        self.labels = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.labels[a], self.labels[b]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b], axis=1)
        if not pairs.size:
            return
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for x, y in pairs.T.tolist():
            x, y = top(x), top(y)
            parent[max(x, y)] = min(x, y)
        moved = np.arange(len(self.labels))
        for x in parent:
            moved[x] = top(x)
        self.labels = moved[self.labels]


def near(shared_a, bits_a, shared_b, bits_b, distance: int) -> np.ndarray:
    """Whether groups may hold a pair within `distance`: counts the bits that both share and that differ."""
    return np.bitwise_count((bits_a ^ bits_b) & shared_a & shared_b) <= distance


def upper_nodes(shared: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared bits of each run of LEAF nodes, and which bits those are."""
    cuts = np.arange(0, len(bits), LEAF)
    ones = np.bitwise_and.reduceat(bits & shared, cuts)
    zeros = np.bitwise_and.reduceat(~bits & shared, cuts)
    return ones | zeros, ones


def link_group(fps: np.ndarray, distance: int) -> np.ndarray:
    """The representative of each fingerprint of one node (in Gray order): equal if a chain of links joins them."""
    n, forest = len(fps), Forest(len(fps))
    near_by = np.arange(n - 1)
    forest.join(*((p := near_by[np.bitwise_count(fps[:-1] ^ fps[1:]) <= distance]), p + 1))
    leaf_shared, leaf_bits = upper_nodes(np.full(n, 2**64 - 1, np.uint64), fps)
    top_shared, top_bits = upper_nodes(leaf_shared, leaf_bits)
    tops, leaves = len(top_bits), len(leaf_bits)
    a, b = np.triu_indices(tops)
    ok = near(top_shared[a], top_bits[a], top_shared[b], top_bits[b], distance)
    within = np.arange(LEAF)
    for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
        i, j = (v.ravel() for v in np.meshgrid(x * LEAF + within, y * LEAF + within, indexing="ij"))
        use = (i <= j) & (i < leaves) & (j < leaves)
        i, j = i[use], j[use]
        use = near(leaf_shared[i], leaf_bits[i], leaf_shared[j], leaf_bits[j], distance)
        i, j = i[use], j[use]
        # Leaves of one set have nothing to add.
        cuts = np.arange(0, n, LEAF)
        low, high = np.minimum.reduceat(forest.labels, cuts), np.maximum.reduceat(forest.labels, cuts)
        use = ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))
        i, j = i[use], j[use]
        if not len(i):
            continue
        p = np.repeat((i[:, None] * LEAF + within), LEAF, axis=1).ravel()
        q = np.tile((j[:, None] * LEAF + within), (1, LEAF)).ravel()
        use = (p < q) & (q < n)
        p, q = p[use], q[use]
        use = np.bitwise_count(fps[p] ^ fps[q]) <= distance
        forest.join(p[use], q[use])
    return fps[forest.labels]


def link_groups(keys: np.ndarray, fps: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """Links between the fingerprints of whole nodes: enough of them to connect all that are near."""
    cuts = np.flatnonzero(np.diff(keys)) + 1
    first = np.concatenate(([0], cuts))
    sizes = np.diff(np.append(first, len(keys)))
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, min(SMALL, int(sizes.max()))):
        use = np.flatnonzero(
            small[:-step] & (keys[:-step] == keys[step:]) & (np.bitwise_count(fps[:-step] ^ fps[step:]) <= distance)
        )
        if len(use):
            yield record_batch(LINK, len(use), fp=fps[use], other=fps[use + step])
    for at in np.flatnonzero(sizes > SMALL).tolist():
        own = fps[first[at] : first[at] + sizes[at]]
        roots = link_group(own, distance)
        use = np.flatnonzero(roots != own)
        if len(use):
            yield record_batch(LINK, len(use), fp=own[use], other=roots[use])


def walk_nodes(batches: Iterator[pa.RecordBatch], distance: int, node_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of key and rank: links of the nodes that are small enough, the rest handed down.

    Holds one node of at most `node_rows` and one batch.
    """
    held_keys, held_masks, held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    too_large: tuple[int, int] | None = None

    def given_down(fps: np.ndarray, key: int, mask: int) -> pa.RecordBatch:
        rows = hand_down(fps, key & (2**64 - 1), mask & (2**64 - 1), distance)
        return record_batch(HANDED_DOWN, len(rows["fp"]), **rows)

    for batch in batches:
        keys, masks, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "mask", "fp"))
        fps = fps.view(np.uint64)
        if too_large is not None:
            upto = int(np.searchsorted(keys, too_large[0], "right"))
            if upto:
                yield given_down(fps[:upto], *too_large)
            if upto == len(keys):
                continue
            keys, masks, fps, too_large = keys[upto:], masks[upto:], fps[upto:], None
        keys, masks, fps = (np.concatenate(x) for x in ((held_keys, keys), (held_masks, masks), (held, fps)))
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
        sizes, free = np.diff(cuts), 64 - np.bitwise_count(masks[cuts[:-1]].view(np.uint64))
        large = (sizes > node_rows) & (free > FEW_FREE_BITS)
        for at in np.flatnonzero(large).tolist():
            yield given_down(fps[cuts[at] : cuts[at + 1]], int(keys[cuts[at]]), int(masks[cuts[at]]))
        if large[-1]:
            too_large = int(keys[-1]), int(masks[-1])
        open_from = cuts[-2]
        done = np.repeat(~large, sizes)
        done[open_from:] = False
        if done.any():
            yield from link_groups(keys[done], fps[done], distance)
        if large[-1]:
            open_from = len(keys)
        held_keys, held_masks, held = keys[open_from:], masks[open_from:], fps[open_from:]
    if len(held):
        yield from link_groups(held_keys, held, distance)


def route(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        rows = hand_down(fps, 0, 0, distance)
        yield record_batch(HANDED_DOWN, len(rows["fp"]), **rows)


def hamming_links(distinct: DataFrame, distance: int = 3, node_rows: int = NODE_ROWS) -> DataFrame:
    """Pairs (a, b) of near fingerprints: a part of all pairs that connects the same ones.

    `distinct`: one 64-bit column without repetitions or nulls.
    """
    rows = map_arrow(distinct, partial(route, distance=distance), ROUTED)
    links: DataFrame | None = None
    while True:
        ordered = rows.repartition("key").sortWithinPartitions("key", "rank")
        found = stored(map_arrow(ordered, partial(walk_nodes, distance=distance, node_rows=node_rows), ROUTED), "nodes")
        new = found.filter(F.col("kind") == LINK).select(F.col("fp").alias("a"), F.col("other").alias("b"))
        links = new if links is None else links.unionByName(new)
        rows = found.filter(F.col("kind") == HANDED_DOWN)
        if rows.isEmpty():
            return links


def near_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    distance: int = 3,
    seed: int = 42,
    text_keys: bool = False,
) -> DataFrame:
    """Columns `id`, `fingerprint` and `component_id` (the smallest id that links reach), one row per row of `docs`.

    Texts that are null or have no words have fingerprint 0 and link like any other. Repeated rows
    stay rows of their own. A null id is never the smallest; a component of nulls alone has null.
    `text_keys` adds the key of the text (`_k1`, `_k2`) and the component itself (`_root`).
    """
    keys = text_key(text) if text_keys else []
    source = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"), *keys)
    known = stored(fingerprints(source, "_text", words, seed).drop("_text"), "fingerprints")
    classes = stored(
        known.groupBy("fingerprint").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_n")), "classes"
    )
    links = hamming_links(classes.select("fingerprint"), distance)
    roots = connected_components(links).withColumnRenamed("node", "fingerprint")
    rooted = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = stored(rooted, "rooted")
    more = [F.col("root").alias("_root"), "_k1", "_k2"] if text_keys else []
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = stored(rooted.join(least, "root").select("fingerprint", "component_id", *more[:1]), "components")
    total = known.count()
    hot = classes.filter(is_hot("_n", total)).select("fingerprint")
    joined = join_hot(known, named, ["fingerprint"], hot)
    return joined.select(F.col("_id").alias(id), "fingerprint", "component_id", *(["_root", "_k1", "_k2"] if text_keys else []))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that represent their component: of its smallest id, one text. Repeated rows count as one.

    Rows of one id are told apart by their texts. Documents without an id stay.
    """
    first = near_groups(docs, id, text, **settings, text_keys=True).filter(F.col(id) == F.col("component_id"))
    chosen = first.groupBy(id, "_root").agg(F.min(F.struct("_k1", "_k2")).alias("_key"), F.count(F.lit(1)).alias("_n"))
    kept = chosen.groupBy(F.col(id).alias("_kept")).agg(F.collect_list("_key").alias("_keys"), F.sum("_n").alias("_rows"))
    # Both parts join the same shuffled rows; repeated ones are few.
    found = docs.join(kept, F.col(id) == F.col("_kept")).filter(F.array_contains("_keys", F.struct(*text_key(text))))
    once = found.filter(F.col("_rows") == 1).select(docs.columns)
    more = found.filter(F.col("_rows") > 1).select(*docs.columns, *text_key(text))
    more = more.dropDuplicates([id, "_k1", "_k2"]).select(docs.columns)
    return once.unionByName(more).unionByName(docs.filter(F.col(id).isNull()))
