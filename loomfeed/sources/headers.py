"""The first record of every file, by one job that reads only the beginning of each."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeed.sources.quotes import inside_after

# A task for each file, whatever its size.
_WHOLE = str(1 << 50)
_LINES_AT_ONCE = "64"
# A file whose lines end with a carriage return alone looks like one long line.
_LONGEST_HEADER = 1 << 16


@dataclass(frozen=True)
class FileHeader:
    """A file as it is listed, and its first record with the line end left on."""

    uri: str
    number: int
    size: int
    text: str

    @property
    def path(self) -> str:
        """A path to read exactly this file: escapes undone, pattern characters escaped."""
        return exact_path(unquote(self.uri))

    @property
    def line_sep(self) -> str | None:
        """What ends the header line: CRLF, or Spark's default for None."""
        return "\r\n" if self.text.endswith("\r") and "\r" not in self._bare() else None

    @property
    def can_cut(self) -> bool:
        """Whether lines end with a line feed, so that records can be found by lines."""
        return "\r" not in self._bare()

    def _bare(self) -> str:
        return self.text.removesuffix("\r").replace("\r\n", "\n")

    @property
    def fields(self) -> tuple[str | None, ...]:
        """The names in the header as written, None for blank ones."""
        text = self.text.removeprefix("﻿").removesuffix("\r")
        names = next(csv.reader(io.StringIO(text, newline=""), quotechar='"', doublequote=True), [])
        return tuple(name or None for name in names)


def exact_path(path: str) -> str:
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def pinned_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that cuts files the same way in every scan.

    How files are cut depends on the cores that are registered when a scan is
    planned. Here that number is fixed, so a lost executor between two scans
    doesn't move the cuts.
    """
    session = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions"):
        session.conf.set(name, spark.conf.get(name))
    cores = spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.files.minPartitionNum", cores)
    return session


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths))


def _first_record(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The record at the beginning of a task's file; the rest of the file is not asked for."""
    parts, inside, found = [], False, None
    for batch in batches:
        for uri, number, size, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not parts and line in ("", "\r"):
                continue
            found = {"uri": uri, "number": number, "size": size}
            parts.append(line)
            inside = inside_after(line, inside)
            if not inside:
                break
        if found and not inside:
            break
    if found:
        text = "\n".join(parts)
        one_line = "\r" in text[:-1].replace("\r\n", "\n")
        yield pa.RecordBatch.from_pylist([{**found, "text": text[:_LONGEST_HEADER] if one_line else text}])


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> list[FileHeader]:
    """The header of each file at ``path``, in the order of their names.

    One job with a small task for each file. Blank lines before the header and
    files without any record are passed over. One row per file comes to the
    driver, which lists the files anyway.
    """
    session = pinned_session(spark)
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", _WHOLE)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _LINES_AT_ONCE)
    meta = F.col("_metadata")
    lines = text_lines(session, [path] if isinstance(path, str) else path).select(
        meta["file_path"].alias("uri"), F.xxhash64(meta["file_path"]).alias("number"), meta["file_size"].alias("size"), "value"
    )
    rows = lines.mapInArrow(_first_record, "uri string, number long, size long, text string").collect()
    headers = sorted((FileHeader(**r.asDict()) for r in rows), key=lambda h: h.uri)
    if len({h.number for h in headers}) < len(headers):
        raise RuntimeError("two file names have one hash: rename one of the files")
    return headers
