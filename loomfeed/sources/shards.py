"""Fixed-width shards that a trainer maps into memory, as a Spark data source.

A shard is one NumPy file per column: a whole-number or floating column is one
value a row, an array column one row of equal width. ``index.json`` names the
shards of a written table in order. It is moved into place last, and readers
trust it alone: files of failed, repeated or lost tasks are never seen. Rows
stand in the order of the partitions written, so a table sorted by ``position``
is read back by it.

``ShardRows`` is for a trainer: any row by its number, without Spark, straight from
the mapped files. ``read_shards`` is for Spark: a task per shard.
"""

from __future__ import annotations

import io
import json
import uuid
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

FORMAT = "loomfeed_shards"
INDEX = "index.json"
#: Bytes of all columns after which a shard ends; a task holds one shard.
SHARD_BYTES = 128 << 20
#: Bytes read and handed to Spark at once.
READ_BYTES = 4 << 20

KINDS = {
    T.ByteType: "<i1",
    T.ShortType: "<i2",
    T.IntegerType: "<i4",
    T.LongType: "<i8",
    T.FloatType: "<f4",
    T.DoubleType: "<f8",
}


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def kind_of(field: T.StructField) -> str:
    kind = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType
    if type(kind) not in KINDS:
        raise ValueError(f"column {field.name}: {field.dataType.simpleString()} has no fixed width")
    return KINDS[type(kind)]


@dataclass
class Written(WriterCommitMessage):
    """Shards of a task: name and rows; widths by column, None for single values."""

    shards: list[tuple[str, int]]
    widths: list[int | None] | None


def block_of(column: pa.Array, name: str, kind: str, is_array: bool) -> np.ndarray:
    """The values of a column of a batch, a row each."""
    if column.null_count:
        raise ValueError(f"column {name}: a shard holds no nulls")
    if not is_array:
        return column.to_numpy(zero_copy_only=False).astype(kind, copy=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError(f"column {name}: rows of widths {sizes.min()} to {sizes.max()}")
    values = column.flatten()
    if values.null_count:
        raise ValueError(f"column {name}: a shard holds no nulls")
    width = int(sizes[0]) if len(sizes) else 0
    return values.to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, shard_bytes: int):
        self.path, self.schema, self.shard_bytes = path, schema, shard_bytes
        self.kinds = [kind_of(f) for f in schema.fields]
        self.arrays = [isinstance(f.dataType, T.ArrayType) for f in schema.fields]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        attempt, system, folder = uuid.uuid4().hex, *place_of(self.path)
        system.create_dir(folder, recursive=True)
        shards: list[tuple[str, int]] = []
        widths: list[int | None] | None = None
        held: list[list[np.ndarray]] = []
        rows = 0

        def flush() -> None:
            nonlocal held, rows
            name = f"{attempt}-{len(shards):05d}"
            shards.append((name, rows))
            for i, blocks in enumerate(zip(*held, strict=True)):
                head = io.BytesIO()
                shape = (rows, *blocks[0].shape[1:])
                described = {"descr": self.kinds[i], "fortran_order": False, "shape": shape}
                np.lib.format.write_array_header_1_0(head, described)
                with system.open_output_stream(f"{folder}/{name}.{i}.npy", compression=None) as out:
                    out.write(head.getvalue())
                    for block in blocks:
                        out.write(np.ascontiguousarray(block))
            held, rows = [], 0

        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                blocks = [
                    block_of(batch.column(i), f.name, self.kinds[i], self.arrays[i])
                    for i, f in enumerate(self.schema.fields)
                ]
                found = [b.shape[1] if array else None for b, array in zip(blocks, self.arrays, strict=True)]
                widths = widths or found
                check_widths(self.schema, widths, found)
                each = max(1, sum(b.nbytes for b in blocks) // batch.num_rows)
                most, start = max(1, self.shard_bytes // each), 0
                while start < batch.num_rows:
                    stop = min(batch.num_rows, start + most - rows)
                    held.append([b[start:stop] for b in blocks])
                    rows, start = rows + stop - start, stop
                    if rows == most:
                        flush()
            if rows:
                flush()
        except BaseException:
            self._remove([name for name, _ in shards])
            raise
        return Written(shards, widths)

    def commit(self, messages: list[Written | None]) -> None:
        widths: list[int | None] | None = None
        shards, start = [], 0
        for message in messages:  # in the order of partitions
            if message is None or message.widths is None:
                continue
            widths = widths or message.widths
            check_widths(self.schema, widths, message.widths)
            for name, rows in message.shards:
                shards.append([name, start, rows])
                start += rows
        index = {"schema": self.schema.jsonValue(), "widths": widths, "rows": start, "shards": shards}
        system, folder = place_of(self.path)
        system.create_dir(folder, recursive=True)
        attempt = f"{folder}/_{INDEX}.{uuid.uuid4().hex}"
        with system.open_output_stream(attempt, compression=None) as out:
            out.write(json.dumps(index).encode())
        system.move(attempt, f"{folder}/{INDEX}")

    def abort(self, messages: list[Written | None]) -> None:
        self._remove([name for m in messages if m is not None for name, _ in m.shards])

    def _remove(self, names: list[str]) -> None:
        """What is left behind by a lost executor stays, but no index names it."""
        system, folder = place_of(self.path)
        for name in names:
            for i in range(len(self.kinds)):
                place = f"{folder}/{name}.{i}.npy"
                if system.get_file_info(place).type != fs.FileType.NotFound:
                    system.delete_file(place)


def check_widths(schema: T.StructType, widths: list, found: list) -> None:
    for field, a, b in zip(schema.fields, widths, found, strict=True):
        if a != b:
            raise ValueError(f"column {field.name}: rows of widths {min(a, b)} to {max(a, b)}")


def index_of(path: str) -> dict:
    system, folder = place_of(path)
    place = f"{folder}/{INDEX}"
    if system.get_file_info(place).type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no table of shards at {path}")
    with system.open_input_stream(place, compression=None) as source:
        return json.loads(source.read())


@dataclass
class Shard(InputPartition):
    name: str
    start: int
    rows: int

    def __post_init__(self) -> None:
        self.value = self.name


class ShardReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, row: str):
        self.path, self.schema, self.row = path, schema, row

    def partitions(self) -> Sequence[InputPartition]:
        found = [Shard(*s) for s in index_of(self.path)["shards"]]
        return found or [Shard("", 0, 0)]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        if not partition.rows:
            return
        system, folder = place_of(self.path)
        fields = [f for f in self.schema.fields if f.name != self.row]
        columns = []
        for i in range(len(fields)):
            source = system.open_input_file(f"{folder}/{partition.name}.{i}.npy")
            np.lib.format.read_magic(source)
            shape, _, kind = np.lib.format.read_array_header_1_0(source)
            if shape[0] != partition.rows:
                raise ValueError(f"{partition.name}: {shape[0]} rows, {partition.rows} in the index")
            columns.append((source, shape[1:], kind))
        each = sum(kind.itemsize * int(np.prod(shape)) for _, shape, kind in columns)
        step = max(1, READ_BYTES // max(1, each))
        try:
            for start in range(0, partition.rows, step):
                rows = min(step, partition.rows - start)
                arrays = []
                for source, shape, kind in columns:
                    number = rows * int(np.prod(shape))
                    values = np.frombuffer(source.read(number * kind.itemsize), kind)
                    if len(values) != number:
                        raise ValueError(f"{partition.name}: a column is cut short")
                    array = pa.array(values)
                    if shape:
                        array = pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * shape[0], array)
                    arrays.append(array)
                place = np.arange(partition.start + start, partition.start + start + rows)
                names = [self.row, *(f.name for f in fields)]
                yield pa.RecordBatch.from_arrays([pa.array(place), *arrays], names=names)
        finally:
            for source, _, _ in columns:
                source.close()


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        stored = T.StructType.fromJson(index_of(self.options["path"])["schema"])
        row = self.options.get("row", "row")
        if row.lower() in {n.lower() for n in stored.names}:
            raise ValueError(f"the table has a column {row}: name another for the row number")
        return T.StructType([T.StructField(row, T.LongType()), *stored.fields])

    def reader(self, schema: T.StructType) -> ShardReader:
        return ShardReader(self.options["path"], schema, self.options.get("row", "row"))

    def writer(self, schema: T.StructType, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], schema, int(self.options.get("shard_bytes", SHARD_BYTES)))


def write_shards(df: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Write numbers and arrays of numbers as shards; a path that holds a table is refused.

    Rows must be alike: nulls and arrays of different width are a ``ValueError`` in the
    task, and nothing becomes visible. An empty table has an index and no shards. The
    driver holds a name and two numbers for each shard. No shuffle is added.
    """
    for field in df.schema.fields:
        kind_of(field)
    system, folder = place_of(path)
    if system.get_file_info(f"{folder}/{INDEX}").type != fs.FileType.NotFound:
        raise FileExistsError(f"there is a table of shards at {path}")
    df.sparkSession.dataSource.register(ShardSource)
    df.write.format(FORMAT).mode("append").option("path", path).option("shard_bytes", shard_bytes).save()


def read_shards(spark: SparkSession, path: str, row: str = "row") -> DataFrame:
    """The table of shards, with the number of each row in a column ``row``."""
    spark.dataSource.register(ShardSource)
    return spark.read.format(FORMAT).option("path", path).option("row", row).load()


class ShardRows:
    """Rows of a table of shards on a mounted file system, by number, mapped and not read."""

    def __init__(self, path: str):
        system, self.folder = place_of(path)
        if not isinstance(system, fs.LocalFileSystem):
            raise ValueError("files can only be mapped from a mounted file system")
        index = index_of(path)
        self.names = T.StructType.fromJson(index["schema"]).names
        self.shards, self.rows = index["shards"], index["rows"]
        self.starts = [start for _, start, _ in self.shards]
        self.mapped: dict[int, list[np.ndarray]] = {}

    def __len__(self) -> int:
        return self.rows

    def __getitem__(self, row: int) -> dict[str, np.ndarray]:
        if not -self.rows <= row < self.rows:
            raise IndexError(row)
        row %= self.rows
        at = bisect_right(self.starts, row) - 1
        if at not in self.mapped:
            name = self.shards[at][0]
            files = [f"{self.folder}/{name}.{i}.npy" for i in range(len(self.names))]
            self.mapped[at] = [np.load(f, mmap_mode="r") for f in files]
        place = row - self.starts[at]
        return {n: column[place] for n, column in zip(self.names, self.mapped[at], strict=True)}
