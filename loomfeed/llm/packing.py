"""Packing documents into sequences by cutting stock over the histogram of lengths.

A document is cut into pieces of the full length, which are sequences of their
own, and a rest. Rests are classed by length in units of ``unit`` tokens. The
class histogram, which has at most ``length / unit`` rows whatever the data, is
all the driver sees; column generation turns it into patterns. Rests are ranked
within their class, and ranks are dealt to the places of the patterns.

Ranks come from counts per class and hash bucket, so a class that holds most
rests is spread over tasks. Token ids never move: only keys are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.llm.common import batch_of, raw_texts, slices, store
from loomfeed.llm.cutting_stock import patterns
from loomfeed.llm.tokens import Encoder, borrowed

LENGTH = 1024
UNIT = 8
#: Rests numbered in one group.
BUCKET_ROWS = 50_000


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A written table of pieces: ``key, row, start, length, doc_tokens, ids``.

    ``ids`` are little-endian unsigned 32-bit integers, ``row`` numbers the
    input's rows, so repeated rows stay apart. A null text is an empty one: just
    the end id.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = docs.schema[key].dataType.simpleString()

    def cut(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        found = encoder.encode([bytes(t).decode() for t in raw_texts(batch.column(2))])
        at, starts, sizes, totals, ids = [], [], [], [], []
        for i, tokens in enumerate(found):
            tokens += end
            total = len(tokens) // 4
            for start in range(0, total, length):
                data = tokens[4 * start : 4 * (start + length)]
                at.append(i)
                starts.append(start)
                sizes.append(len(data) // 4)
                totals.append(total)
                ids.append(data)
        schema = pa.schema(
            [("key", batch.schema.field(0).type), ("row", pa.int64()), ("start", pa.int64())]
            + [("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
        )
        rows = pa.array(at, pa.int64())
        columns = [batch.column(0).take(rows), batch.column(1).take(rows), starts, sizes, totals, ids]
        return batch_of(schema, columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with borrowed(tokenizer) as encoder:
            for batch in batches:
                for some in slices(batch, "text"):
                    yield cut(some, encoder)

    rows = docs.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    schema = f"key {kind}, row long, start long, length long, doc_tokens long, ids binary"
    return store(rows.mapInArrow(run, schema).withColumnRenamed("key", key), "pieces")


def place(cut: DataFrame, length: int = LENGTH, unit: int = UNIT, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``row, start, sequence_id, offset`` of every piece; needs ``row, start, length``.

    Sequences are numbered without gaps, offsets within one follow each other
    without gaps, the longest piece first. Equal lengths are ranked by bucket
    and row.
    """
    spark = cut.sparkSession
    full = F.col("length") == length
    rows = cut.select(
        "row",
        "start",
        "length",
        F.when(full, 0).otherwise(F.ceil(F.col("length") / unit)).cast("int").alias("class"),
    )
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    rows = store(
        rows.withColumn("bucket", F.pmod(F.xxhash64("row", "start"), F.lit(buckets)).cast("int")), "rests"
    )
    counts = rows.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.withColumn(
        "nth", F.row_number().over(Window.partitionBy("class", "bucket").orderBy("row", "start")) - 1
    )
    ranked = ranked.join(offsets, ["class", "bucket"]).withColumn("rank", F.col("base") + F.col("nth"))

    histogram = {r["class"]: r["n"] for r in rows.groupBy("class").agg(F.count("*").alias("n")).collect()}
    whole = histogram.pop(0, 0)
    plan = patterns(histogram, length // unit)
    intervals, sequence, dealt = [], 0, dict.fromkeys(histogram, 0)
    for content, times in plan:
        for size, each in content.items():
            intervals.append((size, dealt[size], dealt[size] + each * times, each, sequence))
            dealt[size] += each * times
        sequence += times
    intervals.append((0, 0, whole, 1, sequence))
    # one row per pattern and class in it: bounded by the number of classes, not by the data;
    # handed over by Arrow, as rows of Python would start further workers in the executors
    names = ("class", "from_rank", "to_rank", "each", "first_sequence")
    kinds = (pa.int32(), *[pa.int64()] * 4)
    columns = [pa.array(c, k) for c, k in zip(zip(*intervals, strict=True), kinds, strict=True)]
    table = spark.createDataFrame(pa.table(columns, names=names))
    dealt_rows = ranked.join(
        F.broadcast(table.withColumnRenamed("class", "of")),
        (F.col("class") == F.col("of")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")),
    ).select(
        "row",
        "start",
        "length",
        "class",
        F.expr("first_sequence + (rank - from_rank) div each").alias("sequence_id"),
        F.expr("(rank - from_rank) % each").alias("at"),
    )
    ahead = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("class"), "at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return dealt_rows.select(
        "row", "start", "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
    )


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, unit: int = UNIT,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces with their ids and places. An empty table gives no pieces."""
    cut = pieces(docs, tokenizer, end_id, length, key, text)
    return cut.join(place(cut, length, unit), ["row", "start"]).drop("row")


def sequences(packed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the pieces joined, padded to ``length`` unless the
    size is a power of two."""
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
    )
    size = F.col("n_tokens")
    short = F.when(size.bitwiseAND(size - 1) == 0, 0).otherwise(length - size).cast("int")
    pad = F.unhex(F.repeat(F.lit(np.array([pad_id], dtype="<u4").tobytes().hex()), short))
    data = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return joined.select("sequence_id", "n_tokens", F.concat(data, pad).alias("ids"))


def digests(cut: DataFrame, places: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per piece with the checksum of its written ids."""
    shown = cut.select(key, "row", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return shown.join(places, ["row", "start"]).drop("row")
