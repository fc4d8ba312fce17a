"""WARC derivatives: linked metadata and plain-text conversion records made from response records."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from osspulse.llm.common import map_arrow, sliced

VERSION = "WARC/1.1"
DATE = "2026-01-01T00:00:00Z"
RECORD = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("record_type", "record_id", "refers_to", "target_uri", "date", "content_type")]
    + [T.StructField(c, T.StringType()) for c in ("block_digest", "payload_digest")]
    + [T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("block", T.BinaryType())]
)
# Elements whose text is not shown, and elements that end a line. A tag holds no `<`, so that a page is read in linear time.
HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|head)\b[^<>]*>", re.I)
HIDDEN_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "head")}
LINE = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|table|h[1-6]|article|section|header|footer|nav|main|aside|pre|blockquote|form)\b[^<>]*>", re.I
)
TAG = re.compile(r"<[!?/]?[a-zA-Z][^<>]*>|<![^<>]*>")
TITLE, TITLE_END = re.compile(r"<title\b[^<>]*>", re.I), re.compile(r"</title\s*>", re.I)
LANGUAGE = re.compile(r"<html\b[^<>]*\blang\s*=\s*[\"']?([\w-]+)", re.I)
LINK = re.compile(r"<a\b[^<>]*\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    """An id that the same parts always get."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def one_line(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def serialize(row: dict) -> bytes:
    """The record as it stands in a WARC file. Its named fields come first, then `headers` by name."""
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": row["record_id"],
        "WARC-Date": row["date"],
        "WARC-Target-URI": row["target_uri"],
        "WARC-Refers-To": row["refers_to"],
        "WARC-Block-Digest": row["block_digest"],
        "WARC-Payload-Digest": row["payload_digest"],
        "Content-Type": row["content_type"],
        **{k: v for k, v in sorted(dict(row["headers"] or {}).items())},
        "Content-Length": str(len(row["block"] or b"")),
    }
    lines = [VERSION, *(f"{k}: {one_line(v)}" for k, v in fields.items() if v is not None), "", ""]
    return "\r\n".join(lines).encode() + (row["block"] or b"") + b"\r\n\r\n"


# Record fields that have columns of their own.
NAMED = {
    "warc-type": "record_type",
    "warc-record-id": "record_id",
    "warc-date": "date",
    "warc-target-uri": "target_uri",
    "warc-refers-to": "refers_to",
    "warc-block-digest": "block_digest",
    "warc-payload-digest": "payload_digest",
    "content-type": "content_type",
}


def parse(data: bytes) -> Iterator[dict]:
    """The records of WARC bytes, uncompressed. A cut-off last record is left out."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", start)
        if end < 0:
            return
        row: dict = dict.fromkeys(RECORD.names) | {"headers": {}}
        length = 0
        for line in data[start:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            name, value = name.strip(), value.strip()
            if name.lower() == "content-length":
                length = int(value) if value.isdigit() else 0
            elif name.lower() in NAMED:
                row[NAMED[name.lower()]] = value
            else:
                row["headers"][name] = value
        if end + 4 + length > len(data):
            return
        row["block"] = data[end + 4 : end + 4 + length]
        at = end + 4 + length
        yield row


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files; gzip members are unpacked. One file is read by one task, so files of some 100 MB suit."""
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(_arrow_fields(RECORD))
        for batch in batches:
            for data in batch.column(0).to_pylist():
                plain = []
                while data[:2] == b"\x1f\x8b":
                    member = zlib.decompressobj(31)
                    plain.append(member.decompress(data))
                    data = member.unused_data
                rows = list(parse(b"".join(plain) if plain else data))
                yield pa.RecordBatch.from_pylist(rows, kind)

    return map_arrow(spark.read.format("binaryFile").load(path).select("content"), run, RECORD)


def _arrow_fields(schema: T.StructType) -> list[pa.Field]:
    kinds = {"string": pa.string(), "binary": pa.binary(), "map": pa.map_(pa.string(), pa.string()), "bigint": pa.int64()}
    return [pa.field(f.name, kinds[f.dataType.simpleString().split("<")[0]]) for f in schema.fields]


def responses(pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html", date: str = DATE) -> DataFrame:
    """A response record per page, with the page's id. Null bodies are empty; a null url leaves the target out.

    Equal rows are the same capture and get the same record id.
    """
    source = pages.select(
        F.col(id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(body).cast("string").alias("body")
    )
    schema = T.StructType([source.schema["page_id"], *RECORD.fields])
    own = _arrow_fields(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 2, 4 << 20):
                rows = []
                for page, target, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    payload = (text or "").encode()
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                    block = head.encode() + payload
                    rows.append(
                        {
                            "record_type": "response",
                            "record_id": record_id("response", page, target, digest(block)),
                            "refers_to": None,
                            "target_uri": target,
                            "date": date,
                            "content_type": "application/http; msgtype=response",
                            "block_digest": digest(block),
                            "payload_digest": digest(payload),
                            "headers": {},
                            "block": block,
                        }
                    )
                made = pa.RecordBatch.from_pylist(rows, pa.schema(own))
                yield pa.RecordBatch.from_arrays([part.column(0), *made.columns], names=schema.names)

    return map_arrow(source, run, schema)


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP response; without a blank line all is body."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("latin-1").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return status, [(name.strip(), value.strip()) for name, _, value in pairs if name.strip()], body


def without_hidden(page: str) -> str:
    """`page` with a space in place of each comment and hidden element. One that has no end hides nothing.

    Goes over the page once: what has no end from one place on has none from later places either.
    """
    parts, at, endless = [], 0, set()
    while True:
        begin = next((m for m in HIDDEN.finditer(page, at) if (m[1] or "").lower() not in endless), None)
        if begin is None:
            return "".join([*parts, page[at:]])
        name = (begin[1] or "").lower()
        if name:
            found = HIDDEN_END[name].search(page, begin.end())
            end = found.end() if found else -1
        else:
            end = page.find("-->", begin.end()) + 3
        if end < len("-->"):
            endless.add(name)
            continue
        parts += [page[at : begin.start()], " "]
        at = end


def title_of(page: str) -> str | None:
    begin = TITLE.search(page)
    end = TITLE_END.search(page, begin.end()) if begin else None
    return page[begin.end() : end.start()] if end else None


def plain_text(page: str) -> str:
    """What a page shows: no markup or scripts, a line per block, single spaces."""
    shown = TAG.sub("", LINE.sub("\n", without_hidden(re.sub(r"\s+", " ", page))))
    lines = (" ".join(line.split()) for line in html.unescape(shown).split("\n"))
    return "\n".join(line for line in lines if line)


def derive(row: dict) -> list[dict]:
    """The metadata and the conversion record of a response record; nothing for records of other types."""
    if row["record_type"] != "response":
        return []
    status, headers, body = split_http(row["block"] or b"")
    kinds = [v for k, v in headers if k.lower() == "content-type"]
    charset = re.search(r"charset=[\"']?([\w-]+)", kinds[0] if kinds else "")
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    source = row["record_id"] or record_id("none", row["target_uri"], digest(row["block"] or b""))
    text = plain_text(page).encode()
    title, language = title_of(page), LANGUAGE.search(page)
    conversion_id, metadata_id = record_id("conversion", source), record_id("metadata", source)
    linked = {
        "WARC-Refers-To-Target-URI": row["target_uri"],
        "WARC-Refers-To-Date": row["date"],
        "X-Source-Block-Digest": row["block_digest"] or digest(row["block"] or b""),
        "X-Source-Payload-Digest": row["payload_digest"] or digest(body),
    }
    linked = {k: v for k, v in linked.items() if v is not None}
    fields = [("http-status", status), *((f"http-header-{k.lower()}", v) for k, v in headers)]
    fields += [(f"source-{k.lower()}", v) for k, v in sorted(dict(row["headers"] or {}).items())]
    fields += [("title", " ".join(html.unescape(title).split()))] if title is not None else []
    fields += [("language", language[1].lower())] if language else []
    links = dict.fromkeys(html.unescape(m[1] or m[2] or m[3] or "") for m in LINK.finditer(page))
    fields += [("outlink", link) for link in links]
    fields += [("conversion", conversion_id), ("source-payload-digest", linked["X-Source-Payload-Digest"])]
    block = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields).encode()
    both = {"refers_to": source, "target_uri": row["target_uri"], "date": row["date"]}
    return [
        both
        | {
            "record_type": "metadata",
            "record_id": metadata_id,
            "content_type": "application/warc-fields",
            "block_digest": digest(block),
            "payload_digest": None,
            "headers": linked | {"WARC-Concurrent-To": conversion_id},
            "block": block,
        },
        both
        | {
            "record_type": "conversion",
            "record_id": conversion_id,
            "content_type": "text/plain; charset=utf-8",
            "block_digest": digest(text),
            "payload_digest": digest(text),
            "headers": linked | {"WARC-Concurrent-To": metadata_id},
            "block": text,
        },
    ]


def derivatives(records: DataFrame) -> DataFrame:
    """Derived records with `warc`, their bytes in a WARC file, and the columns of `records` beside the record's own.

    Two records for each response, none for others. A source without an id gets one from its content.
    """
    others = [c for c in records.columns if c not in RECORD.names and c != "warc"]
    ordered = records.select(*others, *RECORD.names)
    own = [*RECORD.fields, T.StructField("warc", T.BinaryType())]
    schema = T.StructType([*(ordered.schema[c] for c in others), *own])
    fields, at = pa.schema(_arrow_fields(T.StructType(own))), len(ordered.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, at, 4 << 20):
                rows, source = [], []
                for i, row in enumerate(part.select(RECORD.names).to_pylist()):
                    for made in derive(row):
                        rows.append(made | {"warc": serialize(made)})
                        source.append(i)
                made = pa.RecordBatch.from_pylist(rows, fields)
                kept = [part.column(c).take(pa.array(source, pa.int64())) for c in others]
                yield pa.RecordBatch.from_arrays([*kept, *made.columns], names=schema.names)

    return map_arrow(ordered, run, schema)
