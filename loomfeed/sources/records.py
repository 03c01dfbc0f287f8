"""Cutting big CSV files with line breaks inside quotes into tasks, and numbering their records.

Spark reads the lines of a file in splits. Whether a split starts inside a
quoted value is not known to its task, so each task finds, for both possible
starts, the end state and how many records begin in it. These two-way
transitions, one small row per split, are chained over the splits of all files.
Then every task knows its start state and the number of its first record, and
joins the lines of its records. A record across splits comes together by a
shuffle of its pieces alone.

Only lines with a quote are looked at one by one; runs of other lines are passed
on as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeed.sources.headers import FileHeader, text_lines
from loomfeed.sources.quotes import inside_after


@dataclass(frozen=True)
class SplitStarts:
    """What each split needs to know: 33 bytes a split, sorted by file and block.

    ``open_files`` end inside a quoted value.
    """

    file: np.ndarray
    block: np.ndarray
    inside: np.ndarray
    origin: np.ndarray
    first: np.ndarray
    open_files: np.ndarray
    starts_of_others: Mapping[str, int]

    def before(self, uri: str) -> int:
        """Records in the files before one that is read in another way."""
        return self.starts_of_others[uri]

    def of(self, file: int, block: int) -> tuple[bool, int, int, int]:
        """Start state, block where the open record began, number of the first record,
        and number of the file's header."""
        low, high = np.searchsorted(self.file, file, "left"), np.searchsorted(self.file, file, "right")
        at = low + int(np.searchsorted(self.block[low:high], block))
        if at == high or self.block[at] != block:
            raise RuntimeError(
                "files are cut in other places than when they were first read: read them again,"
                " or use ingest_examples, which fixes the cuts"
            )
        return bool(self.inside[at]), int(self.origin[at]), int(self.first[at]), int(self.first[low])

    def joins(self, files: Sequence[FileHeader]) -> bool:
        """Whether a record of ``files`` goes over the end of a split, or is never closed."""
        numbers = [f.number for f in files]
        return bool((self.inside & np.isin(self.file, numbers)).any() or np.isin(self.open_files, numbers).any())


def _lines(spark: SparkSession, files: Sequence[FileHeader]) -> DataFrame:
    crlf = {f.line_sep is not None for f in files}
    if len(crlf) != 1:
        raise ValueError("files with one line end are read together")
    meta = F.col("_metadata")
    return text_lines(spark, [f.path for f in files]).select(
        F.xxhash64(meta["file_path"]).alias("file"),
        meta["file_block_start"].alias("block"),
        F.lit(crlf.pop()).alias("crlf"),
        "value",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array, np.ndarray, np.ndarray]]:
    """The lines of each split in a batch, which of them have a quote, and which are blank."""
    file, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)], strict=True):
        if b > a:
            value = batch.column(3).slice(a, b - a)
            blank = pc.equal(value, "")
            if batch.column(2)[a].as_py():
                blank = pc.or_(blank, pc.equal(value, "\r"))
            quoted = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
            yield (int(file[a]), int(block[a])), value, quoted, blank.to_numpy(zero_copy_only=False)


def _transitions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: state after it from outside and from inside, whether a record that is
    open at its start ends in it, and the records that begin in it for both starts."""
    names = ["file", "block", "outside", "inside", "ends", "n_outside", "n_inside"]
    now, states, ends, counts = None, [False, True], False, [0, 0]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*now, *states, ends, *counts), strict=True))])

    for batch in batches:
        for split, value, quoted, blank in _runs(batch):
            if split != now:
                if now:
                    yield row()
                now, states, ends, counts = split, [False, True], False, [0, 0]
            filled = np.concatenate(([0], np.cumsum(~blank))).tolist()
            done = 0
            for at in quoted.tolist():
                line = value[at].as_py()
                for h in (0, 1):
                    if not states[h]:  # the lines before are records, and one begins here
                        counts[h] += filled[at] - filled[done] + 1
                    states[h] = inside_after(line, states[h])
                # once outside, from wherever it started, the open record has ended
                ends = ends or not states[1]
                done = at + 1
            for h in (0, 1):
                if not states[h]:
                    counts[h] += filled[-1] - filled[done]
    if now:
        yield row()


def split_starts(
    spark: SparkSession, groups: Iterable[Sequence[FileHeader]], others: Mapping[int, tuple[str, int]] | None = None
) -> SplitStarts:
    """Chain the splits of all files: one job, one small row per split to the driver.

    Records are numbered in the order of the file names, headers left out.
    ``others`` names files that are read in another way, and how many rows each
    has: they take their place in the numbering.
    """
    uris, found = {}, None
    for files in groups:
        uris |= {f.number: f.uri for f in files}
        some = _lines(spark, files).mapInArrow(
            _transitions,
            "file long, block long, outside boolean, inside boolean, ends boolean, n_outside long, n_inside long",
        )
        found = some if found is None else found.union(some)
    others = others or {}
    table = found.toArrow().to_pydict() if found is not None else {}
    splits: dict[int, list[tuple]] = {n: [] for n in uris}
    for file, *rest in zip(*table.values(), strict=True):
        splits[file].append(tuple(rest))
    out, at, unfinished, skipped = [], 0, [], {}
    for uri, file in sorted([(u, n) for n, u in uris.items()] + [(u, n) for n, (u, _) in others.items()]):
        if file in others:
            skipped[uri] = at
            at += others[file][1]
            continue
        at -= 1  # the header is the first record of its file
        inside, origin = False, 0
        for block, to_outside, to_inside, ends, n_outside, n_inside in sorted(splits[file]):
            out.append((file, block, inside, origin if inside else block, at))
            at += n_inside if inside else n_outside
            # the record open at the end began here, unless the one from before never ended
            origin = origin if inside and not ends else block
            inside = to_inside if inside else to_outside
        if inside:
            unfinished.append(file)
    out.sort()
    kinds = (np.int64, np.int64, bool, np.int64, np.int64)
    columns = list(zip(*out, strict=True)) or [()] * 5
    arrays = (np.array(c, dtype=k) for c, k in zip(columns, kinds, strict=True))
    return SplitStarts(*arrays, np.array(unfinished, dtype=np.int64), skipped)


_SCHEMA = pa.schema(
    [("file", pa.int64()), ("origin", pa.int64()), ("block", pa.int64()), ("number", pa.int64()), ("text", pa.string())]
)


def cut_records(spark: SparkSession, files: Sequence[FileHeader], starts: SplitStarts) -> DataFrame:
    """``number, text``: one row per record of ``files``, by many tasks per file.

    Headers and blank lines are left out. Numbers follow the order of files and
    lines without gaps over all files of ``starts``.
    """
    shared = spark.sparkContext.broadcast(starts)

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, origin, number, header, parts, opened = None, False, 0, 0, 0, [], None

        def piece() -> list[tuple]:
            # a record that began before this split, or goes on behind it
            return [(now[0], origin, now[1], opened, "\n".join(parts))] if parts else []

        for batch in batches:
            for split, value, quoted, blank in _runs(batch):
                if split != now:
                    if rows := piece():
                        yield _batch(rows)
                    now, parts, opened = split, [], None
                    inside, origin, number, header = shared.value.of(*split)
                whole, rows = np.zeros(len(blank), dtype=bool), []
                begins = np.zeros(len(blank), dtype=np.int64)
                done = 0
                # the lines up to each quoted one are records, or go on with the open one
                for at in [*quoted.tolist(), len(blank)]:
                    if inside:
                        parts.extend(value.slice(done, at - done).to_pylist())
                    else:
                        whole[done:at] = begins[done:at] = ~blank[done:at]
                    done = at + 1
                    if at == len(blank):
                        break
                    line = value[at].as_py()
                    after = inside_after(line, inside)
                    if not inside:
                        begins[at] = 1
                        whole[at] = not after
                        if after:
                            parts, origin = [line], split[1]
                            opened = number + int(begins[:at].sum())
                            opened = -1 if opened == header else opened
                    else:
                        parts.append(line)
                        if not after:
                            whole_here = origin == split[1] and opened is not None
                            row = (split[0], None if whole_here else origin, split[1], opened, "\n".join(parts))
                            rows.append(row)
                            parts, opened = [], None
                    inside = after
                numbers = number + np.cumsum(begins) - 1
                number += int(begins.sum())
                whole &= numbers != header
                if whole.any():
                    text = value.filter(pa.array(whole)).cast(pa.string())
                    n = len(text)
                    here = pa.array(np.full(n, split[0])), pa.nulls(n, pa.int64()), pa.array(np.full(n, split[1]))
                    yield pa.RecordBatch.from_arrays([*here, pa.array(numbers[whole]), text], schema=_SCHEMA)
                if rows:
                    yield _batch(rows)
        if rows := piece():
            yield _batch(rows)

    kinds = "file long, origin long, block long, number long, text string"
    found = _lines(spark, files).mapInArrow(join, kinds)
    whole = found.filter("origin is null").select("number", "text")
    every = whole
    if starts.joins(files):
        pieces = found.filter("origin is not null").groupBy("file", "origin").agg(
            F.max("number").alias("number"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p")
        )
        every = whole.union(pieces.select("number", F.array_join(F.transform("p", lambda x: x["text"]), "\n")))
    every = every.filter("number >= 0")
    if files[0].line_sep:
        every = every.withColumn("text", F.regexp_replace("text", "\r\\z", ""))
    return every


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)
