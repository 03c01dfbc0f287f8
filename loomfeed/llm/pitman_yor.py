"""Hierarchical Pitman-Yor language model over words, fitted and applied by Spark jobs.

Restaurants: one per previous word, all with the root restaurant as parent, whose
own base is uniform over the known words and one unknown word. Customers of a
context are the training tokens after it; every table of a context sends a
customer to the root. There are as many restaurants as previous words (told apart
by 40 bits of their hash, so that of 100 million words about 4,500 pairs share one).

Data are dealt by ranges of word hash, so all contexts of a word are in one part,
and a part's seating needs only the totals of the contexts it meets, and sums from
elsewhere. A Gibbs sweep draws the number of tables of every context and word
given the totals of the sweep before (a block of seats at once, by generalized
Stirling numbers), then those of the root. Totals of contexts are made like any
aggregate: each part sends what it holds of a range of contexts, each range adds
up and sends every part the totals of its contexts back. Only two counts a part come
to the driver. Parts, seatings and totals are files in the shared folder, so a sweep
goes on from the sweep before. Predictive probabilities are averaged over the
sweeps after the burn-in.

Documents are read once, in batches. A batch is stored as places among its distinct
pairs of context and word, and sends each part its pairs with their training
counts; it gets back a log probability per pair, added up per document. What
moves is one entry per distinct pair and batch, a few bytes each, and a frequent
pair is one entry in each batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeed.llm.common import (
    batch_of,
    file_system,
    partitions_for,
    raw_texts,
    slices,
    store,
    write_file,
)
from loomfeed.session import fresh_path

CONTEXT_BITS = 40
#: Text of a batch, about.
BATCH_BYTES = 16 << 20
#: Pairs of a part that wait until they are added to the ones before.
PENDING = 1 << 22
BURN_IN, SAMPLES = 1, 2
STRENGTH = 1.0
#: Customers up to which the tables are drawn exactly; beyond, seats are drawn in growing blocks.
EXACT = 64
#: Stand-ins for words: the end of a text, and what is before its first word (the last context).
END, BEGIN = np.uint64(1), np.uint64((1 << 64) - 1)


def text_hashes(text: bytes) -> np.ndarray:
    """Hashes of the lower-cased words and the end."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def squeeze(*arrays: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed byte planes, each as wide as its largest value needs."""
    head, planes = [len(arrays)], []
    for array in arrays:
        array = np.ascontiguousarray(array, dtype="<u8")
        width = (int(array.max()).bit_length() + 7) // 8 if len(array) else 0
        head += [len(array), width]
        planes.append(array.view("u1").reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(head, dtype="<u8").tobytes() + b"".join(planes))


def spread(data: bytes) -> list[np.ndarray]:
    """The arrays of ``squeeze``."""
    data = zstandard.ZstdDecompressor().decompress(data)
    number = int(np.frombuffer(data, "<u8", 1)[0])
    head = np.frombuffer(data, "<u8", 2 * number, 8).tolist()
    at, out = 8 + 16 * number, []
    for n, width in zip(head[::2], head[1::2], strict=True):
        wide = np.zeros((n, 8), dtype="u1")
        wide[:, :width] = np.frombuffer(data, "u1", n * width, at).reshape(width, n).T
        out.append(wide.view("<u8").ravel())
        at += n * width
    return out


def read_file(path: str) -> bytes:
    system, place = file_system(path)
    with system.open_input_stream(place, compression=None) as source:
        return source.read()


def ascending(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of sorted values, and the steps from each to the next; ``cumsum`` undoes it."""
    return values[:1], np.diff(values, prepend=values[:1])


def steps_of(word_of: np.ndarray) -> np.ndarray:
    return np.diff(word_of, prepend=0)  # 0 or 1: each word has a pair


class Batch:
    """Tokens of some documents as places among their distinct pairs and words."""

    def __init__(self, keys: list, held: list, tokens: list[np.ndarray]):
        self.keys, self.held = keys, np.array(held, dtype=bool)
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.words, word_at = np.unique(np.concatenate(tokens), return_inverse=True)
        n = len(self.words)
        before = np.empty_like(word_at)
        before[1:] = word_at[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = n
        pairs, self.pair_at = np.unique(word_at * (n + 1) + before, return_inverse=True)
        self.word_of = pairs // (n + 1)
        self.context = pairs % (n + 1)  # places among these
        self.contexts = np.append(self.words, BEGIN) >> np.uint64(64 - CONTEXT_BITS)
        train = np.repeat(~self.held, self.sizes)
        self.counts = np.bincount(self.pair_at[train], minlength=len(pairs))

    def requests(self, parts: int) -> Iterator[tuple[int, bytes]]:
        """For each part its words and pairs."""
        part = ((self.words >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        edges = np.flatnonzero(np.diff(part, prepend=np.uint64(parts + 1)))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(part)], strict=True):
            x, y = np.searchsorted(self.word_of, (a, b))
            steps = steps_of(self.word_of[x:y] - a)
            met, context = np.unique(self.context[x:y], return_inverse=True)
            words, contexts = ascending(self.words[a:b]), ascending(self.contexts[met])
            yield int(part[a]), squeeze(*words, *contexts, steps, context, self.counts[x:y])

    def rows(self) -> pa.RecordBatch:
        keys = pa.array(self.keys)
        if keys.type == pa.null():
            keys = keys.cast(pa.int64())
        return pa.RecordBatch.from_arrays([keys, pa.array(self.held), pa.array(self.sizes)], ["key", "held", "size"])

    def save(self, path: str) -> None:
        """Documents, their sizes, and the places of their tokens among the pairs."""
        sink = pa.BufferOutputStream()
        rows = self.rows()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_batch(rows)
        rows = sink.getvalue().to_pybytes()
        places = squeeze(self.pair_at, steps_of(self.word_of))
        write_file(path, [len(rows).to_bytes(8, "little"), rows, places])


def saved_batch(path: str) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """Documents, place of each token among the pairs, word of each pair."""
    data = read_file(path)
    size = int.from_bytes(data[:8], "little")
    with pa.ipc.open_stream(data[8 : 8 + size]) as source:
        rows = source.read_next_batch()
    pair_at, steps = spread(data[8 + size :])
    return rows, pair_at.astype(np.int64), np.cumsum(steps.astype(np.int64))


def request_of(data: bytes) -> tuple[np.ndarray, ...]:
    """Words, contexts, and for each pair its places among both and its training count."""
    word, word_steps, context, context_steps, steps, places, counts = spread(data)
    words, contexts = word + np.cumsum(word_steps), context + np.cumsum(context_steps)
    return words, contexts, np.cumsum(steps.astype(np.int64)), places.astype(np.int64), counts.astype(np.int64)


def batches_of(batches: Iterable[pa.RecordBatch]) -> Iterator[Batch]:
    """A bounded batch of keys, held-out marks and tokens at a time."""
    keys, held, tokens, size = [], [], [], 0
    for batch in batches:
        for some in slices(batch, "text"):
            for k, h, t in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), raw_texts(some.column(2)), strict=True):
                keys.append(k)
                held.append(h)
                tokens.append(text_hashes(bytes(t)))
                size += len(t)
            if size >= BATCH_BYTES:
                yield Batch(keys, held, tokens)
                keys, held, tokens, size = [], [], [], 0
    if keys:
        yield Batch(keys, held, tokens)


def stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logs of the generalized Stirling numbers of ``c`` customers at ``t`` tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(most):
        t = np.arange(1, most + 1)
        with np.errstate(divide="ignore"):
            stay = out[c, 1:] + np.log(np.maximum(c - discount * t, 0))
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay)
    return out


def draw_tables(
    customers: np.ndarray, mass: np.ndarray, discount: float, table: np.ndarray, rng: np.random.Generator
) -> np.ndarray:
    """Tables of each dish given its customers; ``mass`` is that of a new table with the dish."""
    out = np.minimum(customers, 1)
    order = np.argsort(customers, kind="stable")
    ordered = customers[order]
    for c in range(2, EXACT + 1):
        a, b = np.searchsorted(ordered, (c, c + 1))
        for at in range(a, b, 1 << 16):
            rows = order[at : min(b, at + (1 << 16))]
            tables = np.arange(1, c + 1)
            weight = table[c, 1 : c + 1][None, :] + tables * np.log(mass[rows])[:, None]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            mark = rng.random(len(rows)) * weight[:, -1]
            out[rows] = 1 + np.minimum((weight < mark[:, None]).sum(axis=1), c - 1)
    rows = order[np.searchsorted(ordered, EXACT + 1) :]
    if len(rows):
        goal, m = customers[rows], mass[rows]
        seated, tables = np.ones(len(rows), dtype=np.int64), np.ones(len(rows), dtype=np.int64)
        while (seated < goal).any():
            block = np.minimum(goal - seated, np.maximum(1, seated // 5))
            chance = m / (m + np.maximum(seated - discount * tables, 1e-9))
            tables += rng.binomial(block, np.clip(chance, 0, 1))
            seated += block
        out[rows] = np.minimum(tables, goal)
    return out


@dataclass
class Totals:
    """Sums over all parts before a sweep."""

    tables: np.ndarray  # of each context of the part
    root_customers: float
    root_tables: float


@dataclass
class Fixed:
    """What the training counts alone decide."""

    tokens: int
    words: int
    discount: float
    root_discount: float

    @property
    def base(self) -> float:
        return 1.0 / (self.words + 1)


class Part:
    """All pairs of some words that occur in training, and their seating.

    ``contexts`` are those of all its pairs and of all pairs it is asked for, in
    order; ``context`` holds places among them, ``customers`` their training tokens.
    """

    def __init__(self, number: int, words, contexts, word_of, context, counts):
        self.number, self.words, self.contexts = number, words, contexts
        self.word_of, self.context, self.counts = word_of, context, counts
        self.keys = word_of * len(contexts) + context
        self.customers = np.zeros(len(contexts))
        self.seat(np.ones(len(counts), dtype=np.int64), np.ones(len(words), dtype=np.int64))

    def seat(self, tables: np.ndarray, root_tables: np.ndarray) -> None:
        self.tables, self.root_tables = tables, root_tables
        # root customers of each word
        self.dishes = np.bincount(self.word_of, weights=tables, minlength=len(self.words)).astype(np.int64)

    def root(self, fixed: Fixed, totals: Totals) -> np.ndarray:
        """The root's probability of each word."""
        new = (STRENGTH + fixed.root_discount * totals.root_tables) * fixed.base
        return (self.dishes - fixed.root_discount * self.root_tables + new) / (STRENGTH + totals.root_customers)

    def sweep(self, fixed: Fixed, totals: Totals, turn: int, seed: int) -> None:
        rng = np.random.default_rng((seed, turn, self.number))
        mass = (STRENGTH + fixed.discount * totals.tables)[self.context] * self.root(fixed, totals)[self.word_of]
        tables = draw_tables(self.counts, mass, fixed.discount, stirling(fixed.discount), rng)
        self.seat(tables, self.root_tables)
        new = np.full(len(self.words), (STRENGTH + fixed.root_discount * totals.root_tables) * fixed.base)
        drawn = draw_tables(self.dishes, new, fixed.root_discount, stirling(fixed.root_discount), rng)
        self.seat(tables, drawn)

    def per_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=values, minlength=len(self.contexts)).astype(np.int64)

    def predict(self, request, fixed: Fixed, totals: Totals) -> np.ndarray:
        """Probability of each pair of a request."""
        words, asked, word_of, places, _ = request
        context = np.searchsorted(self.contexts, asked)[places]
        here = np.minimum(np.searchsorted(self.words, words), max(0, len(self.words) - 1))
        known = self.words[here] == words if len(self.words) else np.zeros(len(words), bool)
        unseen = (STRENGTH + fixed.root_discount * totals.root_tables) * fixed.base
        unseen /= STRENGTH + totals.root_customers
        root = np.where(known, self.root(fixed, totals)[here], unseen) if len(self.words) else np.full(len(words), unseen)
        keys = here[word_of] * len(self.contexts) + context
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        own = np.zeros(len(keys))
        if len(self.keys):
            seen = (self.keys[at] == keys) & known[word_of]
            own = np.where(seen, self.counts[at] - fixed.discount * self.tables[at], 0.0)
        new = (STRENGTH + fixed.discount * totals.tables)[context] * root[word_of]
        return (own + new) / (STRENGTH + self.customers[context])

    def known_counts(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), dtype=np.int64)
        totals = np.bincount(self.word_of, weights=self.counts, minlength=len(self.words)).astype(np.int64)
        here = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[here] == words, totals[here], 0)


class Gathering:
    """The training pairs of a part, added up as requests come in."""

    def __init__(self) -> None:
        self.words, self.contexts = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.pairs = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple] = []
        self.size = 0

    def add(self, data: bytes) -> None:
        words, contexts, word_of, context, counts = request_of(data)
        keep = counts > 0
        self.waiting.append((words[word_of[keep]], contexts[context[keep]], counts[keep], contexts))
        self.size += len(context)
        if self.size >= max(PENDING, len(self.pairs[2])):
            self.settle()

    def settle(self) -> None:
        word_of, context, counts = self.pairs
        waiting = [(self.words[word_of], self.contexts[context], counts, self.contexts), *self.waiting]
        names, asked, numbers, contexts = (np.concatenate(x) for x in zip(*waiting, strict=True))
        self.contexts = np.unique(contexts)
        self.words, word_of = np.unique(names, return_inverse=True)
        most = max(1, len(self.contexts))
        keys, at = np.unique(word_of * most + np.searchsorted(self.contexts, asked), return_inverse=True)
        counts = np.bincount(at, weights=numbers, minlength=len(keys)).astype(np.int64)
        self.pairs = keys // most, keys % most, counts
        self.waiting, self.size = [], 0

    def save(self, path: str) -> None:
        self.settle()
        word_of, context, counts = self.pairs
        write_file(path, [squeeze(self.words, self.contexts, steps_of(word_of), context, counts)])


def in_order(batches: Iterable[pa.RecordBatch], column: int = 0) -> Iterator[tuple[int, list[dict]]]:
    """Runs of rows with one number in a column, a bounded piece of a run at a time."""
    for batch in batches:
        rows = batch.to_pylist()
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][batch.schema.names[column]] != rows[start][batch.schema.names[column]]:
                yield rows[start][batch.schema.names[column]], rows[start:i]
                start = i


def discount_of(once: int, twice: int) -> float:
    """The usual estimate from how many kinds occur once and twice."""
    return float(np.clip(once / max(1, once + 2 * twice), 0.05, 0.95))


class Model:
    """A fitted model: parts, seatings and totals of all sweeps, as files of one folder."""

    def __init__(self, spark: SparkSession, folder: str, count: int, seed: int):
        self.spark, self.folder, self.count, self.seed = spark, folder, count, seed
        self.fixed: Fixed | None = None
        self.sums: list[tuple[float, float]] = []  # root customers and tables after each sweep

    def load(self, number: int, turn: int | None = None) -> tuple[Part, Totals | None] | None:
        """A part, seated as after a sweep, with the totals then; None if nothing is in it."""
        path = f"{self.folder}/part-{number}"
        system, place = file_system(path)
        if system.get_file_info(place).type.name == "NotFound":
            return None
        words, contexts, steps, context, counts = spread(read_file(path))
        word_of = np.cumsum(steps.astype(np.int64))
        part = Part(number, words, contexts, word_of, context.astype(np.int64), counts.astype(np.int64))
        if turn is None:
            return part, None
        customers, tables = self._totals(number, 0)
        part.customers = customers.astype(float)
        if turn:
            (tables,) = self._totals(number, turn)
            seated = spread(read_file(f"{self.folder}/seats-{turn}-{number}"))
            part.seat(*(x.astype(np.int64) for x in seated))
        return part, Totals(tables.astype(float), *self.sums[turn])

    def _totals(self, number: int, turn: int) -> list[np.ndarray]:
        return spread(read_file(f"{self.folder}/totals-{turn}-{number}"))

    def _exchange(self, turn: int, run) -> np.ndarray:
        """Add up over all parts what ``run`` gives: numbers per context, and plain sums.

        The totals of each part's contexts become its file; the sums are returned.
        """
        count, folder = self.count, self.folder
        load = self._loader(None if turn == 0 else turn - 1)
        schema = pa.schema([("range", pa.int32()), ("part", pa.int32()), ("blob", pa.binary()), ("sums", pa.list_(pa.int64()))])
        kinds = "range int, part int, blob binary, sums array<long>"

        def sending(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number in batch.column(0).to_pylist():
                    loaded = load(number)
                    if loaded is None:
                        continue
                    part, values, sums = run(*loaded)
                    marks = (np.arange(count + 1, dtype=np.uint64) << np.uint64(CONTEXT_BITS)) // np.uint64(count)
                    edges = np.searchsorted(part.contexts, marks)
                    for r, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                        if a < b:
                            steps = np.diff(part.contexts[a:b], prepend=marks[r])
                            blob = squeeze(steps, *(v[a:b] for v in values))
                            yield batch_of(schema, [[r], [number], [blob], [sums]])
                            sums = []

        def adding(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, rows = None, []

            def total() -> Iterator[pa.RecordBatch]:
                opened = [spread(r["blob"]) for r in rows]
                contexts = np.concatenate([np.cumsum(o[0]) for o in opened])
                _, at = np.unique(contexts, return_inverse=True)
                totals = [
                    np.bincount(at, weights=np.concatenate(v).astype(float))[at]
                    for v in zip(*(o[1:] for o in opened), strict=True)
                ]
                start = 0
                for r, o in zip(rows, opened, strict=True):
                    blob = squeeze(*(t[start : start + len(o[0])] for t in totals))
                    start += len(o[0])
                    yield batch_of(schema, [[now], [r["part"]], [blob], [r["sums"]]])

            for number, some in in_order(batches):
                if number != now:
                    if rows:
                        yield from total()
                    now, rows = number, []
                rows += some
            if rows:
                yield from total()

        def filing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, opened, sums = None, [], []

            def flush() -> None:
                values = [np.concatenate(v) for v in zip(*opened, strict=True)]
                write_file(f"{folder}/totals-{turn}-{now}", [squeeze(*values)])

            for number, some in in_order(batches, 1):
                if number != now:
                    if opened:
                        flush()
                    now, opened = number, []
                opened += [spread(r["blob"]) for r in some]
                sums += [r["sums"] for r in some if r["sums"]]
            if opened:
                flush()
            yield batch_of(pa.schema([("sums", pa.list_(pa.int64()))]), [sums])

        sent = self.spark.range(0, count, 1, count).mapInArrow(sending, kinds)
        sent = sent.repartition(count, "range").sortWithinPartitions("range", "part").mapInArrow(adding, kinds)
        sent = sent.repartition(count, "part").sortWithinPartitions("part", "range")
        # one short list for each part
        found = sent.mapInArrow(filing, "sums array<long>").collect()
        return np.array([r["sums"] for r in found], dtype=np.int64).sum(axis=0) if found else np.zeros(7, np.int64)

    def _loader(self, turn: int | None):
        """``load`` without what can't be sent to a task."""
        model = Model(None, self.folder, self.count, self.seed)
        model.fixed, model.sums = self.fixed, list(self.sums)
        return lambda number: model.load(number, turn)

    def fit(self, sweeps: int) -> Model:
        def start(part: Part, _):
            pairs, dishes = part.counts, part.dishes
            sums = [pairs.sum(), len(part.words), (pairs == 1).sum(), (pairs == 2).sum(), (dishes == 1).sum(), (dishes == 2).sum()]
            customers, kinds = part.per_context(pairs), part.per_context(part.tables)
            return part, (customers, kinds), [*map(int, sums), len(pairs)]

        tokens, words, *kinds, pairs = self._exchange(0, start).tolist()
        self.fixed = fixed = Fixed(tokens, words, discount_of(*kinds[:2]), discount_of(*kinds[2:]))
        self.sums.append((float(pairs), float(words)))
        folder, seed = self.folder, self.seed
        for turn in range(1, sweeps + 1):

            def sweep(part: Part, totals: Totals, turn: int = turn):
                part.sweep(fixed, totals, turn, seed)
                write_file(f"{folder}/seats-{turn}-{part.number}", [squeeze(part.tables, part.root_tables)])
                sums = [int(part.dishes.sum()), int(part.root_tables.sum())]
                return part, (part.per_context(part.tables),), sums

            customers, tables = self._exchange(turn, sweep).tolist()[:2]
            self.sums.append((float(customers), float(tables)))
        return self

    def answers(self, requests: DataFrame, burn_in: int) -> DataFrame:
        """``batch, part, blob``: log10 probability per pair, training count per word."""
        fixed = self.fixed
        loaders = [self._loader(turn) for turn in range(burn_in + 1, len(self.sums))]
        schema = pa.schema([("batch", pa.string()), ("part", pa.int32()), ("blob", pa.binary())])

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, seated = None, []
            for number, some in in_order(batches):
                if number != now:
                    now, seated = number, [load(number) for load in loaders]
                for row in some:
                    request = request_of(row["blob"])
                    mean = sum(part.predict(request, fixed, totals) for part, totals in seated) / len(seated)
                    logs = np.log10(mean).astype("<f4")
                    counts = seated[0][0].known_counts(request[0])
                    yield batch_of(schema, [[row["batch"]], [number], [squeeze(logs.view("<u4"), counts)]])

        return requests.mapInArrow(run, "batch string, part int, blob binary")


def rows_of(docs: DataFrame, key: str, text: str, held_out) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("key"), held_out.alias("held"), F.col(f"`{text}`").alias("text"))


def score(
    docs: DataFrame, held_out, key: str = "doc_id", text: str = "text",
    burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = 11,
) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``held_out`` is a boolean column: rows that the model doesn't learn from. A
    null or empty text is one end token. Repeated rows are learned and scored
    each; an empty table gives an empty result; without training rows every word
    is unknown. ``docs`` is read once, and a repeated task must meet its rows in the
    same order, as it does with files or a checkpoint.
    """
    spark = docs.sparkSession
    rows = rows_of(docs, key, text, held_out)
    count = max(1, partitions_for(spark))
    folder = fresh_path(spark, "pitman-yor")
    kinds = "part int, batch string, blob binary"
    schema = pa.schema([("part", pa.int32()), ("batch", pa.string()), ("blob", pa.binary())])

    def asking(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        for number, batch in enumerate(batches_of(batches)):
            name = f"{place}-{number}"  # the same when the task is repeated
            batch.save(f"{folder}/batch-{name}")
            for part, blob in batch.requests(count):
                yield batch_of(schema, [[part], [name], [blob]])

    def gathering(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gathered = None, Gathering()
        for batch in batches:
            for number, some in in_order([batch]):
                if number != now:
                    if now is not None:
                        gathered.save(f"{folder}/part-{now}")
                    now, gathered = number, Gathering()
                for row in some:
                    gathered.add(row["blob"])
            yield batch
        if now is not None:
            gathered.save(f"{folder}/part-{now}")

    asked = rows.mapInArrow(asking, kinds).repartition(count, "part").sortWithinPartitions("part", "batch")
    requests = store(asked.mapInArrow(gathering, kinds), "word-requests")
    model = Model(spark, folder, count, seed).fit(burn_in + samples)

    def writing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, opened = None, []

        def flush() -> None:
            logs, counts = (np.concatenate(x) for x in zip(*opened, strict=True))
            write_file(f"{folder}/answer-{now}", [squeeze(logs, counts)])

        names = []
        for name, some in in_order(batches):
            if name != now:
                if opened:
                    flush()
                now, opened = name, []
                names.append(name)
            opened += [spread(r["blob"]) for r in some]
        if opened:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["batch"])

    answers = model.answers(requests, burn_in).repartition(count, "batch").sortWithinPartitions("batch", "part")
    answered = store(answers.mapInArrow(writing, "batch string"), "answered").repartition(count, "batch")
    tokens, words = model.fixed.tokens, model.fixed.words
    names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def adding(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                found, pair_at, word_of = saved_batch(f"{folder}/batch-{name}")
                logs, counts = spread(read_file(f"{folder}/answer-{name}"))
                if len(logs) != len(word_of):
                    raise ValueError("the answers do not fit the batch")
                logs = logs.astype("<u4").view("<f4").astype(np.float64)
                sizes = found.column(2).to_numpy()
                starts = np.cumsum(sizes) - sizes
                own = counts.astype(np.int64)
                base = np.log10((own + 1) / (tokens + words + 1))
                columns = [
                    sizes,
                    np.add.reduceat((own > 0).astype(np.int64)[word_of][pair_at], starts),
                    np.full(len(sizes), tokens),
                    np.add.reduceat(base[word_of][pair_at], starts),
                    np.add.reduceat(logs[pair_at], starts),
                ]
                columns = [found.column(0), found.column(1), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    kinds = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long"
    return answered.mapInArrow(adding, f"{kinds}, base_score double, score double").withColumnRenamed("key", key)
