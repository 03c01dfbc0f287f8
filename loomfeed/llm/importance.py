"""Resampling documents towards a target distribution by hashed n-gram importance.

A 256-byte table lower-cases A-Z and blanks separators in the UTF-8 of a text,
``bytes.split`` yields its words, and ``zlib.crc32`` seeded with the checksum so
far extends n-grams by a word without joining them. Counters of buckets are
reduced per task and then by Spark. The gain of a bucket is the logarithm of how
much more often the target holds it; a document's weight is its mean gain, its
score the weight plus Gumbel noise hashed from its id, so that the highest scores
are a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeed.llm.common import batch_of, map_arrow, only, raw_texts, store, unused, with_fields
from loomfeed.operators.position import ordered_position

BUCKETS = 10_000
ORDER = 2
SEED = 7
PERCENT = 25
LEAST_WORDS = 20
#: Bytes of a text that are split into words at once.
SPLIT_BYTES = 1 << 20


def _folded(c: int) -> int:
    if 0x41 <= c <= 0x5A:
        return c + 32
    return c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20


TABLE = bytes(map(_folded, range(256)))


def words_of(text: bytes, most: int = SPLIT_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part of it at a time."""
    data = text.translate(TABLE)
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + most)
        stop = len(data) if stop < 0 else stop
        if words := data[at:stop].split():
            yield words
        at = stop


def features(text: bytes, order: int = ORDER, most: int = SPLIT_BYTES) -> Iterator[np.ndarray]:
    """crc32 of all runs of 1 to ``order`` words, joined by blanks; repeats included."""
    crc, held = zlib.crc32, []
    for words in words_of(text, most):
        run = held + words
        sums = list(map(crc, run))
        for n in range(order):
            if n:
                sums = list(map(crc, run[n:], map(crc, repeat(b" "), sums)))
            # runs that end among the words held back were counted with the part before
            new = sums[max(0, len(held) - n) :]
            yield np.fromiter(new, np.uint32, len(new))
        held = run[len(run) - order + 1 :] if order > 1 else []


def bucket_counts(rows: DataFrame, text: str, buckets: int, order: int) -> np.ndarray:
    """How often each bucket occurs in all texts; one row per bucket comes to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for body in raw_texts(batch.column(0)):
                for some in features(bytes(body), order):
                    counts.update((some % buckets).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], ["bucket", "n"]
        )

    found = only(rows, text).toDF("text").mapInArrow(run, "bucket long, n long")
    found = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares of each bucket, rounded down."""
    n = len(source)
    s_all, t_all = float(source.sum() + n), float(target.sum() + n)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def noise(key: object, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the key's hash; a null key counts as an empty one."""
    text = f"{seed}:{'' if key is None else key}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    order: int = ORDER,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``key, n_words, n_features, weight, score`` and the columns ``carry`` of every row of ``docs``.

    Null and empty texts have no features and weigh 0; repeated rows count and are
    scored each; further columns are not read.
    """
    table = gains(bucket_counts(docs, text, buckets, order), bucket_counts(target, target_text, buckets, order))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    numbers = ["n_words", "n_features", "weight", "score"]
    plain = only(docs, key, text, *carry).toDF("key", "text", *[f"carried_{i}" for i, _ in enumerate(carry)])
    kinds = T.StructType([f for f in plain.schema.fields if f.name != "text"])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table, rows = shared.value, []
        for one, body in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
            words = n = total = 0
            for i, some in enumerate(features(bytes(body), order)):
                words += 0 if i % order else len(some)
                n += len(some)
                total += int(table[some % buckets].sum())
            weight = total // n if n else 0
            rows.append((words, n, weight, weight + noise(one, seed)))
        kept = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        schema = pa.schema([*[batch.schema.field(i) for i in kept], *[(c, pa.int64()) for c in numbers]])
        columns = [list(c) for c in zip(*rows, strict=True)]
        yield batch_of(schema, [*[batch.column(i) for i in kept], *columns])

    found = map_arrow(plain, run, with_fields(kinds, ", ".join(f"{c} long" for c in numbers)), "text")
    return found.toDF(key, *carry, *numbers)


def draw(
    scored: DataFrame, key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``scored`` with ``rank``: 1 and up for the drawn rows, null for the others.

    Of the N rows with ``least_words`` words, the ``percent`` * N / 100 highest
    scores are drawn, rounded down, ties to the smaller key (null keys first, equal
    keys in any order). Rows are placed by range partitions of short rows, never by
    a sort in one task.
    """
    rows = store(scored, "scored")
    drawn = rows.filter(F.col("n_words") >= least_words).count() * percent // 100
    few, last = unused(rows, "few"), unused(rows, "last")
    ordered = rows.withColumn(few, F.col("n_words") < least_words).withColumn(last, -F.col("score"))
    placed = ordered_position(ordered, [few, last, key], "rank")
    rank = F.when(F.col("rank") < drawn, (F.col("rank") + 1).cast("long"))
    return placed.select(*[F.col(f"`{n}`") for n in rows.columns], rank.alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    **options,
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns.

    Rows are told apart, and ties broken, by a number that a written table fixes,
    so repeated and null keys are rows like any others. ``options`` are those of
    :func:`scores`.
    """
    row = unused(docs, "row")
    placed = store(docs.withColumn(row, F.monotonically_increasing_id()), "resample-rows")
    drawn = draw(scores(placed, target, key, text, carry=[row], **options), row, percent, least_words)
    return only(placed.join(drawn.filter("rank is not null").select(row), row, "left_semi"), *docs.columns)
