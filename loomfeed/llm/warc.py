"""WARC archives with one Zstandard frame per record and a dictionary in front.

An archive starts with a skippable frame (magic ``0x184D2A5D``) that holds the
dictionary, as it is or as a Zstandard frame. Every record is one frame made
with it. Records with equal payloads: the one with the largest id is a
``response``, the others are ``revisit`` records that name it. A revisit keeps
the HTTP head of its payload, so its ``Content-Length`` is that of the full
payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeed.llm.common import batch_of, file_system, partitions_for, raw_texts, slices, store, write_file

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
#: Payload bytes after which an archive ends.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is trained on the first records of its archive, at most so many bytes.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
#: Larger frames or records are refused as damaged.
MOST_BYTES = 1 << 31
CHUNK = 1 << 20
DATE = datetime(2024, 1, 1, tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page))}>"


def clean(value: str | None) -> str:
    """A header value: one line, no blanks around."""
    return " ".join((value or "").split())


def record(page: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record with its head, its HTTP head and, unless it is a revisit, its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean(url) or 'about:blank'}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"X-Page-ID: {page}",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page-ID: {refers_to}",
            f"WARC-Profile: {PROFILE}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes]) -> bytes:
    """A dictionary from the first records; too few give their text as raw content."""
    sample, size = [], 0
    for one in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(one[: 64 << 10])
        size += len(sample[-1])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICTIONARY_BYTES]


def archive(records: list[bytes]) -> Iterator[bytes]:
    """The bytes of an archive, frame by frame."""
    raw = train(records)
    packed = zstandard.ZstdCompressor().compress(raw)
    yield struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
    for one in records:
        yield coder.compress(one)


class Damaged(ValueError):
    """An archive that breaks the format."""


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Heads and blocks of all records of a binary stream, a frame at a time."""
    head = source.read(8)
    buffer, coder = b"", zstandard.ZstdDecompressor()
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", head[4:])[0]
        raw = _exactly(source, size)
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):
            raw = coder.decompress(raw, max_output_size=MOST_BYTES)
        coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    else:
        buffer = head
    while True:
        buffer = buffer or source.read(CHUNK)
        if not buffer:
            return
        frame, parts, size = coder.decompressobj(), [], 0
        while True:
            try:
                parts.append(frame.decompress(buffer))
            except zstandard.ZstdError as error:
                raise Damaged(f"a frame does not decode: {error}") from error
            size += len(parts[-1])
            if size > MOST_BYTES:
                raise Damaged("a record is too long")
            if frame.eof:
                buffer = frame.unused_data
                break
            buffer = source.read(CHUNK)
            if not buffer:
                raise Damaged("the last frame is cut off")
        yield parse(b"".join(parts))


def _exactly(source, size: int) -> bytes:
    data = source.read(size)
    if len(data) != size:
        raise Damaged("the dictionary is cut off")
    return data


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Head fields (lower-case names) and block of one record, lengths and digest checked."""
    end = data.find(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n") if end >= 0 else [""]
    if not lines[0].startswith("WARC/1."):
        raise Damaged("a record does not start with a WARC version")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged(f"not a field: {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise Damaged(f"no {name}")
    if not fields["content-length"].isdigit():
        raise Damaged("content-length is not a number")
    block = data[end + 4 : end + 4 + int(fields["content-length"])]
    if len(data) != end + 4 + int(fields["content-length"]) + 4 or data[-4:] != b"\r\n\r\n":
        raise Damaged("content-length does not fit the frame")
    return fields, block


def payload_of(fields: dict[str, str], block: bytes) -> tuple[int, bytes]:
    """Length of the full payload, and the payload (empty for a revisit); digest checked."""
    end = block.find(b"\r\n\r\n")
    head = block[:end].decode().lower().split("\r\n") if end >= 0 else []
    sizes = [x.partition(":")[2].strip() for x in head if x.startswith("content-length:")]
    if len(sizes) != 1 or not sizes[0].isdigit():
        raise Damaged("the HTTP head has no length")
    payload = block[end + 4 :]
    if fields["warc-type"] == "revisit":
        if payload:
            raise Damaged("a revisit holds a payload")
    elif len(payload) != int(sizes[0]):
        raise Damaged("the payload's length does not fit its HTTP head")
    elif fields.get("warc-payload-digest") != f"sha1:{base32_sha1(payload)}":
        raise Damaged("the payload's digest does not match")
    return int(sizes[0]), payload


def revisits(pages: DataFrame, key: str, text: str, least: int = 0) -> DataFrame:
    """``key, refers_to`` of the rows whose payload a row with a larger key holds too.

    Only keys and digests are shuffled. The largest key of each digest is
    counted before the shuffle; rows of one hot digest meet it in a join that
    adaptive execution can split.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.sha1(data).alias("digest"), F.length(data).alias("size"))
    rows = rows.filter((F.col("size") >= least) & F.col("key").isNotNull()).select("key", F.unhex("digest").alias("digest"))
    largest = rows.groupBy("digest").agg(F.max("key").alias("refers_to"), F.count("*").alias("n"))
    largest = largest.filter("n > 1").drop("n")
    return rows.join(largest, "digest").filter("key < refers_to").select("key", "refers_to").distinct()


def write(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", text: str = "html", least: int = 0
) -> DataFrame:
    """Write one record per row; the manifest ``path, records, bytes``.

    The manifest is a stored table and names the archives of the attempts that were
    committed; archives of other attempts of a task stay unread beside them.

    Null payloads are empty ones. Rows with a null key have no identity to refer
    to; they are responses with page id -1. Rows that repeat a key are written
    each. An empty table gives no archive.
    """
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(text).alias("text"))
    joined = rows.join(revisits(rows, "key", "text", least), "key", "left").select("key", "refers_to", "url", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, number, size = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], 0, 0
        records: list[bytes] = []

        def flush() -> pa.RecordBatch:
            path = f"{folder}/pages-{part:07d}-{number:05d}-{attempt}.warc.zst"
            written = write_file(path, archive(records))
            return pa.RecordBatch.from_pylist([{"path": path, "records": len(records), "bytes": written}])

        for batch in batches:
            for some in slices(batch, "text"):
                keys, refers, urls = (c.to_pylist() for c in some.columns[:3])
                for page, to, link, body in zip(keys, refers, urls, raw_texts(some.column(3)), strict=True):
                    records.append(record(-1 if page is None else page, link, bytes(body), to))
                    size += len(body)
                    if size >= ARCHIVE_BYTES:
                        yield flush()
                        records, size, number = [], 0, number + 1
        if records:
            yield flush()

    return store(joined.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """All records of the archives that a manifest names in ``path``: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, payload`` (null for a revisit).

    A damaged or missing archive, or one whose number of records is not the manifest's, is an
    error. No archives give no rows.
    """
    files = manifest.select("path", "records").repartition(partitions_for(manifest.sparkSession))
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]
        + [("payload", pa.binary())]
    )

    def rows_of(path: str) -> Iterator[tuple]:
        system, place = file_system(path)
        with system.open_input_stream(place, compression=None) as source:
            for fields, block in read_archive(source):
                size, payload = payload_of(fields, block)
                page = int(fields["x-page-id"])
                to = fields.get("x-refers-to-page-id")
                yield (
                    None if page < 0 else page,
                    size,
                    fields["warc-payload-digest"].removeprefix("sha1:"),
                    fields["warc-type"],
                    None if to is None else int(to),
                    fields["warc-target-uri"],
                    None if fields["warc-type"] == "revisit" else payload,
                )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, size, found = [], 0, 0
                for row in rows_of(path):
                    found += 1
                    rows.append(row)
                    size += row[1] + 100
                    if size > 4 << 20:
                        yield batch_of(schema, [list(c) for c in zip(*rows, strict=True)])
                        rows, size = [], 0
                if found != records:
                    raise Damaged(f"{path}: {found} records, {records} written")
                if rows:
                    yield batch_of(schema, [list(c) for c in zip(*rows, strict=True)])

    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.mapInArrow(run, f"{kinds}, url string, payload binary")
