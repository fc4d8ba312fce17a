"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

A uniform permutation of n rows sends a number of rows from each block of the input to each part
of the output that follows the multivariate hypergeometric distribution. That matrix is drawn first, exactly. Then every
block permutes its rows and deals them out by its line of the matrix, the rows are exchanged, and every
part permutes what it has received. Permutations come from a seed and the block's number, so a
task that runs again makes the same one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.common import map_arrow, stored, without

# Rows of a block at least; more if there would be more than BLOCKS blocks, to bound the matrix.
BLOCK_ROWS, BLOCKS = 1 << 14, 2000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` rows are good, without replacement; for any size.

    Inverts the distribution around its mode, from ratios of neighbouring terms. What lies beyond
    thirteen standard deviations and a margin has a mass below the rounding of a double.
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    share = good / total
    spread = (drawn * share * (1 - share) * (total - drawn) / max(total - 1, 1)) ** 0.5
    reach = int(13 * spread) + 60
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    # Ratio of the term at k + 1 to that at k.
    ratio = (good - k) / (k + 1) * ((drawn - k) / (bad - drawn + k + 1))
    up, down = np.cumprod(ratio[mode - a :]), np.cumprod(1 / ratio[: mode - a][::-1])[::-1]
    weights = np.concatenate((down, [1.0], up))
    sums = np.cumsum(weights)
    return a + int(np.searchsorted(sums, rng.random() * sums[-1], "right").clip(0, b - a))


def communication_matrix(rng: np.random.Generator, from_sizes: list[int], to_sizes: list[int]) -> np.ndarray:
    """Rows sent from each block to each part: its lines add up to `from_sizes`, its columns to `to_sizes`."""
    left = list(map(int, to_sizes))
    matrix = np.zeros((len(from_sizes), len(to_sizes)), np.int64)
    for i, size in enumerate(from_sizes):
        drawn, others = int(size), sum(left)
        for j, room in enumerate(left):
            others -= room
            sent = hypergeometric(rng, room, others, drawn)
            matrix[i, j] = sent
            left[j] -= sent
            drawn -= sent
    return matrix


@lru_cache(maxsize=4)
def permutation(seed: int, side: int, block: int, size: int) -> np.ndarray:
    return np.random.default_rng((seed, side, block)).permutation(size)


class Plan:
    """Sizes, offsets and the matrix, as arrays of a size that the number of blocks bounds."""

    def __init__(self, per_partition: dict[int, int], shards: int, seed: int, block_rows: int):
        self.seed = seed
        self.n = sum(per_partition.values())
        self.block_rows = max(block_rows, -(-self.n // BLOCKS))
        self.partitions = np.array(sorted(per_partition), np.int64)
        counts = np.array([per_partition[int(p)] for p in self.partitions], np.int64)
        self.base = np.cumsum(counts) - counts
        blocks = -(-self.n // self.block_rows)
        self.block_sizes = [min(self.block_rows, self.n - i * self.block_rows) for i in range(blocks)]
        shard_sizes = [self.n // shards + (i < self.n % shards) for i in range(shards)]
        self.part_shard, self.part_offset, self.part_sizes = [], [], []
        for shard, size in enumerate(shard_sizes):
            parts = max(1, -(-size // self.block_rows))
            at = 0
            for k in range(parts):
                own = size // parts + (k < size % parts)
                self.part_shard.append(shard)
                self.part_offset.append(at)
                self.part_sizes.append(own)
                at += own
        self.matrix = communication_matrix(np.random.default_rng((seed, 0)), self.block_sizes, self.part_sizes)
        # Last place of each part in a permuted block, and rows of earlier blocks in each part.
        self.upto = np.cumsum(self.matrix, axis=1)
        self.before = np.cumsum(self.matrix, axis=0) - self.matrix

    def deal(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part and place in it, before the second permutation, of rows given by partition and number."""
        partition, number = rows >> 33, rows & ((1 << 33) - 1)
        at = self.base[np.searchsorted(self.partitions, partition)] + number
        block, place = at // self.block_rows, at % self.block_rows
        part, arrival = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for b in np.unique(block).tolist():
            use = np.flatnonzero(block == b)
            drawn = permutation(self.seed, 1, b, self.block_sizes[b])[place[use]]
            to = np.searchsorted(self.upto[b], drawn, "right")
            part[use] = to
            arrival[use] = self.before[b, to] + drawn - (self.upto[b, to] - self.matrix[b, to])
        return part, arrival

    def settle(self, part: np.ndarray, arrival: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of rows that have arrived."""
        slot = np.zeros(len(part), np.int64)
        for p in np.unique(part).tolist():
            use = np.flatnonzero(part == p)
            slot[use] = self.part_offset[p] + permutation(self.seed, 2, p, self.part_sizes[p])[arrival[use]]
        return np.asarray(self.part_shard)[part], slot


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`df` with `shard` (0 to `shards` - 1) and `slot` (gapless from 0 in each shard), in slot order.

    Every assignment of rows to slots is as likely as any other; shard sizes differ by one at most.
    Rows count one by one: nulls, equal and repeated rows are like any others. The rows are stored once, as
    the counts and the dealing must see the same order.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    kept = stored(without(df, ["shard", "slot"]).withColumn("_row", F.monotonically_increasing_id()), "rows")
    counts = kept.groupBy(F.shiftright("_row", 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    plan = df.sparkSession.sparkContext.broadcast(Plan({r.p: r.n for r in counts}, shards, seed, block_rows))
    two = [T.StructField("_part", T.LongType()), T.StructField("_arrival", T.LongType())]
    dealt = T.StructType([*kept.schema.fields, *two])
    last = T.StructType([*kept.schema.fields[:-1], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = plan.value.deal(batch.column(batch.num_columns - 1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=dealt.names)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, _, part, arrival = batch.columns
            shard, slot = plan.value.settle(part.to_numpy(), arrival.to_numpy())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(shard, pa.int32()), pa.array(slot)], names=last.names)

    parts = max(1, len(plan.value.part_sizes))
    # A task for each part.
    exchanged = map_arrow(kept, deal, dealt).repartitionById(parts, F.col("_part").cast("int"))
    return map_arrow(exchanged, settle, last).sortWithinPartitions("shard", "slot")
