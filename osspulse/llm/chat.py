"""Chat formatting by columnar byte assembly.

A batch of turns, in order, becomes one byte array: the lengths of headers, texts and footers give each
segment's offset, and scatter indices copy all of them into a buffer of the exact size. Conversations are slices of
that buffer. A turn reads `<|im_start|>role`, a line break, the text, `<|im_end|>` and a line break. In a text, `<`,
any backslashes and `|` get one more backslash, so control strings occur in the template's places only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.bytestext import flatten
from osspulse.llm.common import map_arrow, stored

# Fixed values of the template.
START, END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"
LOSS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))


def escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\1\\|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_roles(roles: pa.Array) -> pa.Array:
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("<", "\\l")):
        roles = pc.replace_substring(roles, plain, written)
    return roles


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role)


def assemble(segments: list[pa.Array | str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows' segments one behind the other in one buffer, and the offset of each segment (rows x segments + 1)."""
    parts = []
    for segment in segments:
        if isinstance(segment, str):
            raw = np.frombuffer(segment.encode(), np.uint8)
            parts.append((raw, None, np.full(n, len(raw), np.int64)))
        else:
            data, offsets = flatten(segment)
            parts.append((data, offsets[:-1], np.diff(offsets)))
    lengths = np.stack([p[2] for p in parts], axis=1)
    offsets = np.concatenate(([0], np.cumsum(lengths.ravel()))).astype(np.int64)
    out = np.empty(int(offsets[-1]), np.uint8)
    place = offsets[:-1].reshape(n, len(parts))
    for k, (data, begin, length) in enumerate(parts):
        if begin is None:
            out[place[:, k, None] + np.arange(len(data))] = data
            continue
        total = int(length.sum())
        # Where each byte of the column goes: its segment's place plus its own place in the segment.
        out[np.repeat(place[:, k] - begin, length) + np.arange(total)] = data
    return out, offsets


def format_batch(conv: pa.Array, roles: pa.Array, texts: pa.Array, part: int) -> pa.RecordBatch:
    n = len(conv)
    roles, texts = pc.fill_null(roles, ""), pc.fill_null(texts, "")
    segments = [START, escaped_roles(roles), "\n", escaped(texts), END + "\n"]
    out, offsets = assemble(segments, n)
    begin = offsets[:-1].reshape(n, len(segments))
    trained = pc.equal(roles, TRAINED).to_numpy(zero_copy_only=False)
    codes = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    bounds = np.append(begin[first, 0], offsets[-1])
    strings = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out))
    rows = np.flatnonzero(trained)
    of = np.searchsorted(first, rows, "right") - 1
    loss = pa.StructArray.from_arrays(
        [pa.array(begin[rows, 3] - bounds[of]), pa.array(begin[rows, 4] - begin[rows, 3])], ["start", "length"]
    )
    lists = np.searchsorted(of, np.arange(len(first) + 1)).astype(np.int32)
    edge = np.zeros(len(first), bool)
    edge[[0, -1]] = True
    return pa.RecordBatch.from_arrays(
        [
            conv.take(pa.array(first)),
            pa.array(np.full(len(first), part)),
            pa.array(edge),
            pa.array(np.diff(np.append(first, n))),
            strings.cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(lists), loss),
        ],
        names=["conv_id", "part", "edge", "n_turns", "formatted", "loss"],
    )


def format_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Formatted text of conversations: conv_id, part, edge, n_turns, formatted, loss (spans of bytes to train on).

    Turns go by `turn` (nulls first), ties by role and text; null roles and texts are empty; rows
    without a conversation id form one conversation. A conversation is one row unless it lies over
    several tasks or batches: then its parts, in order of `part`, are to be put together. Rows with
    `edge` false are whole for certain. So no task needs to hold all of a long conversation.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    partitions = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "tie"]
    ordered = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order, "text")
    schema = T.StructType(
        [
            rows.schema["conv_id"],
            T.StructField("part", T.LongType()),
            T.StructField("edge", T.BooleanType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("loss", LOSS),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            if batch.num_rows:
                yield format_batch(batch.column("conv_id"), batch.column("role"), batch.column("text"), part)
                part += 1

    return map_arrow(ordered, run, schema)


TURN = re.compile(re.escape(START) + "([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of the turns of a formatted text."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


class Digest:
    """What is read back from the parts of one conversation, part after part."""

    def __init__(self):
        self.turns = self.chars = self.loss_chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        raw = formatted.encode()
        for span in loss:
            text = unescape(raw[span["start"] : span["start"] + span["length"]].decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digest_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from parts in order; holds one digest and one batch."""
    now, open_digest = None, None
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def made(ids: list, rows: list, kind: pa.DataType) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns], names=names)

    kind = None
    for batch in batches:
        ids, rows = [], []
        kind = batch.column("conv_id").type
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))
        for conv, formatted, loss in zip(*columns, strict=True):
            if open_digest is None or conv != now:
                if open_digest is not None:
                    ids.append(now)
                    rows.append(open_digest.row())
                now, open_digest = conv, Digest()
            open_digest.add(formatted, loss)
        yield made(ids, rows, kind)
    if open_digest is not None:
        yield made([now], [open_digest.row()], kind)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text alone: turns, digests and lengths.

    Whole conversations are read where they are; only the parts of the others are brought together.
    """
    parts = stored(formatted, "formatted")
    schema = T.StructType(
        [
            parts.schema["conv_id"],
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    whole = map_arrow(parts.filter("not edge"), digest_parts, schema)
    split = parts.filter("edge").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(map_arrow(split, digest_parts, schema))
