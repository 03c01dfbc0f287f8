"""Benchmark decontamination: an FM-index per shard of training text.

Each slice of documents that a task reads is a shard. Only words that some
benchmark window holds can be part of a match, so a shard's index is built over
the runs of such words that are long enough for the shortest window. All windows
are searched backwards at once, their occurrences located and their spans merged
per document. Documents do not move: the plan has no shuffle for one block of
windows.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text, which bounds
what is broadcast; each block is one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeed.llm.common import batch_of, map_arrow, only, raw_texts, store, unused, with_fields, without
from loomfeed.llm.fm_index import FMIndex

WINDOW = 10
#: Benchmark text handled in one pass over the documents.
BLOCK_BYTES = 16 << 20

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of other characters, blanks the rest.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: bytes | memoryview) -> list[bytes]:
    return bytes(text).translate(FOLD).split()


class Windows:
    """The distinct windows of a block of items, as symbol rows."""

    def __init__(self, items: list[tuple[object, bytes]], window: int = WINDOW):
        self.symbols: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set[int]] = {}
        self.items = [item for item, _ in items]
        for i, (_, text) in enumerate(items):
            ids = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                rows.setdefault(tuple(ids[at : at + window]), set()).add(i)
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.patterns = np.zeros((len(rows), window), dtype=np.int64)
        for i, row in enumerate(rows):
            self.patterns[i, : len(row)] = row
        self.owners = [sorted(x) for x in rows.values()]
        self.shortest = int(self.lengths.min()) if rows else 0

    def find(self, texts: list) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
        """Per text: number of words, merged hit spans, places of the items found."""
        counts, shard, starts, owner = [], [np.zeros(1, np.int64)], [], []
        size, get = 1, self.symbols.get
        for i, text in enumerate(texts):
            words = words_of(text)
            counts.append(len(words))
            if not self.shortest or len(words) < self.shortest:
                continue
            ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
            edges = np.flatnonzero(np.diff(np.concatenate(([0], ids != 0, [0]))))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if b - a >= self.shortest:
                    shard += [ids[a:b], np.zeros(1, np.int64)]
                    starts.append(size)
                    owner.append((i, a))
                    size += b - a + 1
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[int]] = [set() for _ in texts]
        if starts:
            index = FMIndex(np.concatenate(shard), len(self.symbols))
            low, high = index.search(self.patterns, self.lengths)
            found = np.repeat(np.arange(len(low)), high - low)
            first = np.cumsum(high - low) - (high - low)
            rows = low[found] + np.arange(len(found)) - first[found]
            places = index.locate(rows)
            at = np.searchsorted(starts, places, "right") - 1
            for window, place, k in zip(found.tolist(), places.tolist(), at.tolist(), strict=True):
                i, begin = owner[k]
                begin += place - starts[k]
                spans[i].append((begin, begin + int(self.lengths[window])))
                items[i].update(self.owners[window])
        return [(n, merge(s), sorted(t)) for n, s, t in zip(counts, spans, items, strict=True)]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPANS = "array<struct<start:int,stop:int>>"


def blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[object, bytes]]]:
    """The items with text, a bounded block at a time."""
    rows, size = [], 0
    for row in only(benchmark, item, text).filter(F.col(text).isNotNull()).toLocalIterator():
        body = row[1].encode()
        if rows and size + len(body) > most:
            yield rows
            rows, size = [], 0
        rows.append((row[0], body))
        size += len(body)
    yield rows


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    item: str = "item_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (hit words, merged) and ``items`` (ids as sorted strings).

    A null text has no words. Items without words have no window; equal windows
    of several items count for each; the id of an item without one is not
    listed. Repeated rows are searched each. Columns of ``docs`` named like the
    three added ones are replaced.

    The driver and the executors hold one block of the benchmark at a time: with
    several blocks, rows are numbered in a written table, the hits of each block
    are written before the next is read, and all are joined by that number.
    """
    return _search(docs, benchmark, window, item, text, block_bytes, cut=False)


def cut_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    item: str = "item_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """What ``find_leaks`` gives, with the hit spans cut out of the text.

    The texts are cut where they are searched: ``remove_leaks`` upon ``find_leaks``
    in one task would keep a second Python process with as much memory again.
    """
    return _search(docs, benchmark, window, item, text, block_bytes, cut=True)


def _search(
    docs: DataFrame, benchmark: DataFrame, window: int, item: str, text: str, block_bytes: int, cut: bool
) -> DataFrame:
    docs = without(docs, "n_words", "spans", "items")
    given = blocks(benchmark, item, text, block_bytes)
    part, further = next(given), next(given, None)
    if further is None:
        return _pass(docs, Windows(part, window), text, cut)[0]
    row = unused(docs, "row")
    rows = store(docs.withColumn(row, F.monotonically_increasing_id()), "leak-rows")
    found = None
    while part is not None:
        one, shared = _pass(rows.select(row, F.col(f"`{text}`").alias("text")), Windows(part, window), "text")
        one = store(one.drop("text"), "leak-hits")
        shared.destroy()
        found = one if found is None else found.union(one)
        part, further = further, next(given, None)
    joined = (
        found.groupBy(row)
        .agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .withColumn("spans", _merged(F.col("spans")))
    )
    found = rows.join(joined, row).drop(row)
    return _cut(found, text, found.columns) if cut else found


def _merged(spans):
    """Sorted spans with overlapping and touching ones joined."""
    empty = F.lit(None).cast(SPANS)
    return F.aggregate(
        spans,
        F.coalesce(empty, F.array().cast(SPANS)),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["stop"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def _pass(docs: DataFrame, windows: Windows, text: str, cut: bool = False) -> tuple[DataFrame, Broadcast]:
    """The hits of one block, cut out of the text on request, and what was broadcast for them."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    names = docs.columns

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        windows, place = shared.value, names.index(text)
        found = windows.find(raw_texts(batch.column(place)))
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        extra = pa.schema([("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))])
        spans = [[{"start": a, "stop": b} for a, b in s] for _, s, _ in found]
        added = [
            [n for n, _, _ in found],
            spans,
            [sorted({str(windows.items[i]) for i in t if windows.items[i] is not None}) for _, _, t in found],
        ]
        columns = list(batch.columns)
        if cut:
            columns[place] = _without_spans(columns[place], spans)
        yield batch_of(pa.schema([*batch.schema, *extra]), [*columns, *added])

    return map_arrow(docs, run, with_fields(docs.schema, f"n_words long, spans {SPANS}, items array<string>"), text), shared


def cut_words(text: str | None, spans: list) -> str | None:
    """The text without the hit words and the white space and marks after each."""
    if not spans or text is None:
        return text
    data = text.encode()
    folded = data.translate(FOLD)
    starts, at, word = [], 0, False
    array = np.frombuffer(folded, np.uint8) != 32
    starts = np.flatnonzero(np.diff(np.concatenate(([0], array.view(np.int8)))) == 1)
    out, at = [], 0
    for span in spans:
        a, b = span["start"], span["stop"]
        out.append(data[at : starts[a]])
        at = int(starts[b]) if b < len(starts) else len(data)
    out.append(data[at:])
    return b"".join(out).decode()


def remove_leaks(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with the hit spans cut out of the text, but for those
    that ``find_leaks`` replaced."""
    docs = without(docs, "n_words", "spans", "items")
    return _cut(only(found, *docs.columns, "spans"), text, docs.columns)


def _cut(found: DataFrame, text: str, names: list[str]) -> DataFrame:
    """The first columns of ``found``, which are ``names``, with the hit spans cut out of the text."""
    place, spans = names.index(text), found.columns.index("spans")
    schema = only(found, *names).schema

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = list(batch.columns[: len(names)])
        columns[place] = _without_spans(columns[place], batch.column(spans).to_pylist())
        yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[: len(names)]))

    return map_arrow(found, run, schema, text)


def _without_spans(texts: pa.Array, spans: list) -> pa.Array:
    if not any(spans):
        return texts
    return pa.array([cut_words(t, s) for t, s in zip(texts.to_pylist(), spans, strict=True)], type=texts.type)
