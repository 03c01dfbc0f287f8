"""Exact substring dedup with suffix automata of reference shards.

A window of ``window`` words is anchored at the leftmost smallest hash among
its groups of ``ANCHOR`` words, so equal windows have equal anchors. Consecutive
windows with one anchor form a run. A reference shard holds all repeated
passages around one anchor: every distinct run with the number of times it
occurs. Each shard becomes one suffix automaton with occurrence counts; the runs
are streamed through it for matching statistics, and maximal spans that occur
twice or more and reach the threshold are removed.

Sending every automaton to every document would cost documents times shards.
Here an automaton meets just the runs with its anchor, so every window is looked
at once. Runs are collapsed and counted before any words move, so a passage that
many documents share is one row. A shard with more than ``HOT`` distinct runs is
split: its windows are collapsed and become shards of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeed.llm.automaton import SuffixAutomaton
from loomfeed.llm.common import batch_of, bitmap, hits, map_arrow, only, partitions_for, raw_texts, store, unused, with_fields, without

WINDOW = 35
#: Words of an anchor.
ANCHOR = 8
#: Distinct runs of a shard above which it is split by window.
HOT = 2048
#: log2 of the bits of the prefilters; 2 MB each, whatever the data.
BITS = 24
MULTIPLIER = 0x9E3779B97F4A7C15
SPANS = "array<struct<start:int,stop:int>>"


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def anchors(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the group at each place, and for each window the place of its anchor."""
    n = len(hashes) - anchor + 1
    value = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(anchor):
            value = value * np.uint64(MULTIPLIER) + hashes[j : j + n]
        value ^= value >> np.uint64(31)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(29)
    width = window - anchor + 1
    low, at, reach = value, np.arange(n), 1
    while reach < width:
        step = min(reach, width - reach)
        later = low[step:] < low[: len(low) - step]
        at = np.where(later, at[step:], at[: len(at) - step])
        low = np.where(later, low[step:], low[: len(low) - step])
        reach += step
    return value, at


def runs_of(text: bytes, window: int, anchor: int) -> tuple[int, tuple[np.ndarray, ...]]:
    """Number of words, and per run: anchor, content, first window, last window."""
    words = text.split()
    if len(words) < window:
        return len(words), (np.empty(0, np.int64),) * 4
    hashes = word_hashes(words)
    value, at = anchors(hashes, window, anchor)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    view = memoryview(hashes).cast("B")
    digest = xxhash.xxh3_64_intdigest
    content = np.fromiter(
        (digest(view[8 * a : 8 * (b + window)]) for a, b in zip(first.tolist(), last.tolist(), strict=True)),
        np.uint64,
        len(first),
    )
    return len(words), (value[at[first]].view(np.int64), content.view(np.int64), first, last)


def text_key(text: Column) -> Column:
    """Identity of a text; equal texts are handled once."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def all_runs(docs: DataFrame, text: str, window: int, anchor: int) -> DataFrame:
    lists = {"anchor": pa.int64(), "content": pa.int64(), "first": pa.int32(), "last": pa.int32()}
    schema = pa.schema([("key", pa.binary()), *((k, pa.list_(t)) for k, t in lists.items())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [runs_of(bytes(x), window, anchor)[1] for x in raw_texts(batch.column(1))]
        offsets = pa.array(np.concatenate(([0], np.cumsum([len(x[0]) for x in found]))), pa.int32())
        flat = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[i] for x in found]), kind))
            for i, kind in enumerate(lists.values())
        ]
        yield batch_of(schema, [batch.column(0), *flat])

    kinds = "anchor array<long>, content array<long>, first array<int>, last array<int>"
    rows = docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"key binary, {kinds}", "text").filter(F.size("anchor") > 0)


def candidates(runs: DataFrame, filter_bits: np.ndarray) -> DataFrame:
    """One row per run whose anchor may occur twice."""
    shared = runs.sparkSession.sparkContext.broadcast(filter_bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(i) for i in range(1, 5)]
            parents = pa.compute.list_parent_indices(lists[0])
            flat = [x.flatten() for x in lists]
            keep = pa.array(hits(shared.value, flat[0].to_numpy(zero_copy_only=False)))
            columns = [batch.column(0).take(parents.filter(keep)), *(x.filter(keep) for x in flat)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "content", "first", "last"])

    return runs.mapInArrow(run, "key binary, anchor long, content long, first int, last int")


def find_repeats(
    docs: DataFrame, text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT
) -> DataFrame:
    """``key, spans``: for each distinct text with repeats, the covered words."""
    spark = docs.sparkSession
    runs = store(all_runs(docs, text, window, anchor), "runs")
    again = (
        runs.select(F.explode("anchor").alias("anchor"))
        .groupBy("anchor")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
    found = store(candidates(runs, bitmap(again, "anchor", BITS)), "repeat-candidates")

    distinct = found.groupBy("anchor", "content").agg(
        F.count("*").alias("weight"), F.min(F.struct("key", "first", "last")).alias("at")
    )
    distinct = store(distinct, "repeat-runs")
    shards = (
        distinct.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.sum("weight").alias("total"))
        .filter("total > 1")
    )
    wanted = (
        distinct.join(shards, "anchor")
        .select("at.*", "anchor", "content", "weight", (F.col("n") > hot).alias("split"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("anchor", "content", "first", "last", "weight", "split")).alias("runs"))
    )
    wanted = store(wanted, "repeat-wanted")
    marks = bitmap(wanted.select(F.xxhash64("key").alias("key")), "key", BITS)
    texts = _texts_of(docs, text, marks).dropDuplicates(["key"])
    segments = store(_segments(texts.join(wanted, "key"), window), "segments")

    parts = max(partitions_for(spark), 8)
    whole = segments.filter("off < 0").select("shard", "content", "weight", "words")
    spans = _stream(whole.repartition(parts, "shard"), window).select(
        F.col("shard").alias("anchor"), "content", "spans"
    )
    cut = segments.filter("off >= 0")
    windows = cut.groupBy("shard", "words").agg(F.sum("weight").alias("weight"))
    repeated = _stream(
        windows.select("shard", F.xxhash64("words").alias("content"), "weight", "words")
        .repartition(parts, "shard"),
        window,
    ).select("shard", "content")
    split = (
        cut.select("shard", F.xxhash64("words").alias("window"), "anchor", "content", "off")
        .join(repeated.withColumnRenamed("content", "window"), ["shard", "window"])
        .groupBy("anchor", "content")
        .agg(
            F.collect_list(
                F.struct(F.col("off").alias("start"), (F.col("off") + window).cast("int").alias("stop"))
            ).alias("spans")
        )
    )
    every = store(spans.union(split), "repeat-spans")
    covered = (
        found.join(every, ["anchor", "content"])
        .select("key", "first", "spans")
        .dropDuplicates(["key", "first"])
        .select("key", F.expr(f"cast(transform(spans, s -> struct(s.start + first as start, s.stop + first as stop)) as {SPANS})").alias("spans"))
        .groupBy("key")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    )
    return covered


def _texts_of(docs: DataFrame, text: str, marks: np.ndarray) -> DataFrame:
    """``key, text`` of the texts whose key may be marked."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    rows = docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    rows = rows.select("key", "text", F.xxhash64("key").alias("mark"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(hits(shared.value, batch.column(2).to_numpy()))
            yield batch.filter(keep).select([0, 1])

    return rows.mapInArrow(run, "key binary, text string")


def _segments(joined: DataFrame, window: int) -> DataFrame:
    """The words (as hashes) of each distinct run, or of each window where a shard is split."""
    schema = pa.schema(
        [("shard", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64())]
        + [("off", pa.int32()), ("weight", pa.int64()), ("words", pa.binary())]
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for text, runs in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            hashes = memoryview(word_hashes(bytes(text).split())).cast("B")
            rows = []
            for r in runs:
                a, b = r["first"], r["last"]
                if not r["split"]:
                    words = bytes(hashes[8 * a : 8 * (b + window)])
                    rows.append((r["anchor"], r["anchor"], r["content"], -1, r["weight"], words))
                    continue
                for at in range(a, b + 1):
                    words = bytes(hashes[8 * at : 8 * (at + window)])
                    shard = xxhash.xxh3_64_intdigest(words) - (1 << 63)
                    rows.append((shard, r["anchor"], r["content"], at - a, r["weight"], words))
            yield batch_of(schema, [list(c) for c in zip(*rows, strict=True)])

    rows = joined.select("key", "text", "runs")
    return map_arrow(
        rows, run, "shard long, anchor long, content long, off int, weight long, words binary", "text"
    )


def _stream(segments: DataFrame, window: int) -> DataFrame:
    """Build the automaton of each shard and stream its runs; rows with repeats only."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    schema = pa.schema([("shard", pa.int64()), ("content", pa.int64()), ("spans", span)])

    def spans_of(rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, list]]:
        if len(rows) == 1:  # no two windows of one run are equal: a chain of states with one count
            content, weight, words = rows[0]
            if weight > 1:
                yield content, [(0, len(words) // 8)]
            return
        lists = [(np.frombuffer(w, np.int64).tolist(), n) for _, n, w in rows]
        automaton = SuffixAutomaton(lists)
        for (content, _, _), (words, _) in zip(rows, lists, strict=True):
            if found := automaton.repeated(words, window):
                yield content, found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []

        def flush() -> None:
            for content, spans in spans_of(rows):
                out.append((now, content, [{"start": a, "stop": b} for a, b in spans]))

        for batch in batches:
            for shard, content, weight, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != now:
                    flush()
                    now, rows = shard, []
                rows.append((content, weight, words))
            if len(out) > 4096:
                yield batch_of(schema, [list(c) for c in zip(*out, strict=True)])
                out = []
        flush()
        if out:
            yield batch_of(schema, [list(c) for c in zip(*out, strict=True)])

    rows = segments.select("shard", "content", "weight", "words").sortWithinPartitions("shard")
    return rows.mapInArrow(run, f"shard long, content long, spans {SPANS}")


WHITE = bytes(32 if c in (9, 10, 11, 12, 13, 32) else c for c in range(256))


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the words of the spans and the white space after each; words before, removed."""
    if not spans:
        return text, len(text.split()), 0
    array = np.frombuffer(text.translate(WHITE), np.uint8) != 32
    starts = np.flatnonzero(np.diff(np.concatenate(([0], array.view(np.int8)))) == 1)
    ends = starts.tolist() + [len(text)]
    out, at, done, removed = [], 0, 0, 0
    for a, b in spans:
        a = max(a, done)
        if b <= a:
            continue
        out.append(text[at : ends[a]])
        at, done = ends[b], b
        removed += b - a
    out.append(text[at:])
    return b"".join(out), len(starts), removed


def remove_repeats(
    docs: DataFrame, text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT
) -> DataFrame:
    """``docs`` with the repeated words cut from ``text``, and ``n_words``, ``n_removed``.

    All occurrences of a repeated window go, also those within one text and
    those in equal rows. A null text stays null and has no words; texts shorter
    than the window stay as they are; an empty table gives an empty result;
    further columns are carried along, but for ones named like the two counts,
    which these replace.
    """
    docs = without(docs, "n_words", "n_removed")
    found = find_repeats(docs, text, window, anchor, hot)
    names = docs.columns
    place = names.index(text)
    of, marks = unused(docs, "of"), unused(docs, "marks")
    keyed = docs.select("*", text_key(F.col(f"`{text}`")).alias(of))
    joined = only(keyed.join(found.select(F.col("key").alias(of), F.col("spans").alias(marks)), of, "left"), *names, marks)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = batch.column(place)
        lists = batch.column(len(names)).to_pylist()
        done = [
            cut(bytes(t), [(s["start"], s["stop"]) for s in spans or ()])
            for t, spans in zip(raw_texts(column), lists, strict=True)
        ]
        texts = pa.array([x[0].decode() for x in done], type=column.type)
        if column.null_count:
            texts = pa.compute.if_else(column.is_null(), pa.scalar(None, column.type), texts)
        columns = list(batch.columns[: len(names)])
        columns[place] = texts
        counts = [pa.array([x[i] for x in done], pa.int64()) for i in (1, 2)]
        fields = list(batch.schema)[: len(names)]
        yield pa.RecordBatch.from_arrays(
            [*columns, *counts], schema=pa.schema([*fields, ("n_words", pa.int64()), ("n_removed", pa.int64())])
        )

    return map_arrow(joined, run, with_fields(docs.schema, "n_words long, n_removed long"), text)


def sha256_of_words(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()
