"""Token ids in files of rANS-coded blocks, in ascending key order.

File layout (little-endian)::

    b"LFRANS1\\n"
    u32 part, u32 number in part, u64 ids of the part before this file,
    u64 ids, u32 documents, u32 blocks, u32 crc32 of the frequency table
    documents x (u8 key is null, i64 key, u64 ids)
    blocks x (u64 place in the file, u32 bytes)
    u32 crc32 of all of the above
    the blocks (see ``rans``), independent of each other

One more file holds the shared frequency table. File names sort in key order;
a document is never cut between files, but may be cut between blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomfeed.llm import rans
from loomfeed.llm.common import (
    batch_of,
    file_system,
    partitions_for,
    raw_texts,
    slices,
    store,
    write_file,
)
from loomfeed.llm.tokens import borrowed

MAGIC = b"LFRANS1\n"
HEAD = struct.Struct("<IIQQIII")
#: Ids after which a file ends with the document at hand.
FILE_IDS = 4 << 20
BLOCK_IDS = 1 << 20
LANES = 1024
#: Steps between checkpoints.
EVERY = 256
TABLE = "table.frequencies"
DOCUMENT = np.dtype([("null", "u1"), ("key", "<i8"), ("size", "<u8")])
PLACE = np.dtype([("at", "<u8"), ("bytes", "<u4")])


def segments(
    docs: DataFrame, tokenizer: str, end_id: int, key: str, text: str, file_ids: int = FILE_IDS
) -> DataFrame:
    """Written table of the files' contents: tokenized documents in key order.

    The rows are dealt by ranges of key (ties by a hash of the text) and sorted,
    each task numbers its files, and ids are kept compressed.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("tie"), F.col(text).alias("text")
    )
    parts = partitions_for(docs.sparkSession)
    rows = rows.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie")
    schema = pa.schema(
        [("part", pa.int32()), ("number", pa.int32()), ("before", pa.int64())]
        + [("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number = before = held = 0
        keys, data = [], []

        def flush() -> pa.RecordBatch:
            packed = zstandard.ZstdCompressor(level=1).compress(b"".join(data))
            sizes = [len(d) // 4 for d in data]
            return batch_of(schema, [[part], [number], [before], [keys], [sizes], [packed]])

        with borrowed(tokenizer) as encoder:
            for batch in batches:
                for some in slices(batch, "text"):
                    texts = [bytes(t).decode() for t in raw_texts(some.column(2))]
                    for k, ids in zip(some.column(0).to_pylist(), encoder.encode(texts), strict=True):
                        keys.append(k)
                        data.append(ids + end)
                        held += len(data[-1]) // 4
                        if held >= file_ids:
                            yield flush()
                            number, before, held = number + 1, before + held, 0
                            keys, data = [], []
        if keys:
            yield flush()

    found = rows.mapInArrow(
        run, "part int, number int, before long, keys array<long>, sizes array<long>, ids binary"
    )
    return store(found, "token-segments")


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4")


def frequencies(rows: DataFrame) -> np.ndarray:
    """Counts of all ids over all files; at most one row per id comes to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                more = np.bincount(unpack(data), minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    found = rows.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = found.toArrow()
    ids = found["id"].to_numpy()
    out = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=np.int64)
    out[ids] = found["n"].to_numpy()
    return out


def file_bytes(part, number, before, keys, sizes, ids: np.ndarray, table: rans.Table) -> bytes:
    blocks = [
        rans.encode(ids[at : at + BLOCK_IDS], table, LANES, EVERY) for at in range(0, len(ids), BLOCK_IDS)
    ]
    documents = np.zeros(len(keys), dtype=DOCUMENT)
    documents["null"] = [k is None for k in keys]
    documents["key"] = [k or 0 for k in keys]
    documents["size"] = sizes
    head = MAGIC + HEAD.pack(part, number, before, len(ids), len(keys), len(blocks), table.checksum())
    at = len(head) + documents.nbytes + PLACE.itemsize * len(blocks) + 4
    places = np.zeros(len(blocks), dtype=PLACE)
    for i, block in enumerate(blocks):
        places[i] = (at, len(block))
        at += len(block)
    head += documents.tobytes() + places.tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(blocks)


def parse(data: bytes, table: rans.Table) -> tuple[tuple[int, int, int], np.ndarray, list[memoryview]]:
    """Place of the file, its documents and its blocks, all checked."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    part, number, before, n, documents, blocks, checksum = HEAD.unpack_from(data, len(MAGIC))
    if checksum != table.checksum():
        raise ValueError("the file was written with another frequency table")
    at = len(MAGIC) + HEAD.size
    docs = np.frombuffer(data, DOCUMENT, documents, at)
    at += docs.nbytes
    places = np.frombuffer(data, PLACE, blocks, at)
    at += places.nbytes
    if zlib.crc32(memoryview(data)[:at]) != struct.unpack_from("<I", data, at)[0]:
        raise ValueError("header checksum does not match")
    if int(docs["size"].sum()) != n:
        raise ValueError("document sizes do not add up")
    view = memoryview(data)
    return (part, number, before), docs, [view[at : at + size] for at, size in places.tolist()]


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the files of ``docs``; the manifest ``path, part, number, documents, ids, bytes``.

    A null text is empty (just the end id), null keys come first, equal rows are
    written each. Keys are integers. An empty table gives the table file alone.
    """
    rows = segments(docs, tokenizer, end_id, key, text, file_ids)
    table = rans.Table(rans.quantize(frequencies(rows)))
    write_file(f"{folder}/{TABLE}", [table.frequency.astype("<u4").tobytes()])
    shared = docs.sparkSession.sparkContext.broadcast(table.frequency)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                part, number, before, keys, sizes, packed = (c[row].as_py() for c in batch.columns)
                ids = unpack(packed)
                data = file_bytes(part, number, before, keys, sizes, ids, table)
                path = f"{folder}/ids-{part:07d}-{number:07d}.rans"
                write_file(path, [data])
                names = ["path", "part", "number", "documents", "ids", "bytes"]
                values = [path, part, number, len(keys), len(ids), len(data)]
                yield pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))])

    kinds = "path string, part long, number long, documents long, ids long, bytes long"
    return store(rows.mapInArrow(run, kinds), "token-manifest")


def read_table(folder: str) -> rans.Table:
    system, place = file_system(f"{folder}/{TABLE}")
    with system.open_input_stream(place, compression=None) as source:
        return rans.Table(np.frombuffer(source.read(), "<u4"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Decode all files below ``folder``: ``doc_id, part, before, n_tokens, ids``.

    ``before`` counts the ids of the part before the document. Spark lists the
    files; a task decodes a file block by block and checks every checksum.
    """
    shared = spark.sparkContext.broadcast(read_table(folder).frequency)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rans").load(folder).select("path")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.int64()), ("before", pa.int64())]
        + [("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(shared.value)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = file_system(path)
                with system.open_input_stream(place, compression=None) as source:
                    data = source.read()
                (part, _, before), docs, blocks = parse(data, table)
                ids = np.concatenate([rans.decode(b, table) for b in blocks] or [np.empty(0, np.uint32)])
                stops = np.cumsum(docs["size"]).astype(np.int64)
                starts = stops - docs["size"].astype(np.int64)
                raw = ids.astype("<u4").tobytes()
                for at in range(0, len(docs), 1024):
                    some = slice(at, at + 1024)
                    keys = pa.array(docs["key"][some], pa.int64(), mask=docs["null"][some].astype(bool))
                    data = [raw[4 * a : 4 * b] for a, b in zip(starts[some], stops[some], strict=True)]
                    n = len(keys)
                    columns = [keys, np.full(n, part), starts[some] + before, stops[some] - starts[some], data]
                    yield batch_of(schema, columns)

    return files.mapInArrow(run, "doc_id long, part long, before long, n_tokens long, ids binary")


def digests(found: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of decoded documents.

    Only a count per part, of which there are as many as shuffle partitions, is
    added up in one place.
    """
    rows = store(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "decoded")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
