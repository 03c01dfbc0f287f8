"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeed.session import fresh_path

#: Text handed to the inner loops at once, so that a worker's memory is bounded.
SLICE_BYTES = 4 << 20


def store(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(spark.read.parquet(path).schema).parquet(path)


def map_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | T.StructType, text: str
) -> DataFrame:
    """``mapInArrow`` that hands over slices of at most about ``SLICE_BYTES`` of ``text``."""

    names = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.rename_columns(names), text):
                yield from function(part)

    # mapInArrow would take a dot in a name for a field of a struct
    return df.toDF(*[n.replace(".", "_") + f"_{i}" for i, n in enumerate(names)]).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch after the row that brings its text to ``most`` bytes."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.array([len(x) for x in raw_texts(column)], dtype=np.int64)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw_texts(column: pa.Array) -> list[memoryview | bytes]:
    """The UTF-8 bytes of each value, empty for null."""
    if not len(column):
        return []
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    null = column.is_null().to_pylist() if column.null_count else None
    return [
        b"" if null and null[i] else view[at[i] : at[i + 1]] for i in range(len(column))
    ]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_fields(schema: T.StructType, added: str) -> T.StructType:
    """``schema`` with the fields of a schema text after its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(added).fields])


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, by position-free reference, whatever else the table holds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as ``df`` needs to have no such column."""
    taken = {n.lower() for n in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, which the caller is about to add."""
    return only(df, *[n for n in df.columns if n.lower() not in names])


# files in the shared folder, through any file system that pyarrow knows


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def write_file(path: str, chunks: Iterable[bytes]) -> int:
    """Write under a name of its own, then rename, so that a repeated task leaves one whole file."""
    system, place = file_system(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    head, _, name = place.rpartition("/")
    attempt = f"{head}/_{name}.{uuid.uuid4().hex}"
    size = 0
    with system.open_output_stream(attempt, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    system.move(attempt, place)
    return size


# prefilters of a fixed size


def bitmap(keys: DataFrame, name: str, bits: int) -> np.ndarray:
    """``2**bits`` bits with those of the keys set: its size doesn't depend on the data.

    Only used to leave out rows before a shuffle; a join decides. At most
    ``2**(bits - 6)`` rows come to the driver.
    """
    place = F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        keys.select(F.shiftright(place, 6).alias("at"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word"))
        .toArrow()
    )
    out = np.zeros(1 << max(0, bits - 6), dtype=np.uint64)
    out[words["at"].to_numpy()] = words["word"].to_numpy().view(np.uint64)
    return out


def hits(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64 keys may be in a ``bitmap``."""
    place = keys.view(np.uint64) & np.uint64(len(table) * 64 - 1)
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
