"""SimHash near-duplicates through an inverted index of positional bytes.

Two fingerprints that differ in at most two bits differ in at most two of their
eight bytes, so they share at least six positional bytes, and at least two of
the four neighbouring byte pairs entirely. The index lists every fingerprint
under its six combinations of two byte pairs. Within a list the shared
positional bytes of each pair are tallied, pairs below six are left, the rest
are verified by their bits. A pair is taken from the first list it shares.

A list longer than ``longest`` is not paired off. There each fingerprint is put
under itself and its one-bit neighbours; fingerprints link exactly if they meet
under one of these (33 rows each, groups of at most 33), which gives the same
components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeed.llm.common import batch_of, map_arrow, only, raw_texts, store, unused
from loomfeed.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Two differing bits spoil two bytes at most.
LEAST_BYTES = 8 - DISTANCE
#: Lists up to this length are paired off.
LONGEST = 128
#: Combinations of two of the four 16-bit parts.
COMBINATIONS = list(combinations(range(4), 2))
ROWS_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles of a lower-cased text; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    stops = ends[shingle - 1 :].tolist()
    n = len(stops)
    values = np.fromiter(
        (digest(line[a:b], seed) for a, b in zip(starts[:n].tolist(), stops, strict=True)),
        np.uint64,
        n,
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, ROWS_AT_ONCE):
        some = values[at : at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` (the 64 bits as a long) of every row; null and empty texts get 0."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = np.array([fingerprint(bytes(x)) for x in raw_texts(batch.column(1))], dtype=np.uint64)
        schema = pa.schema([("key", batch.schema.field(0).type), ("fp", pa.int64())])
        yield batch_of(schema, [batch.column(0), values.view(np.int64)])

    rows = only(docs, key, text).toDF("key", "text")
    return map_arrow(rows, run, f"key {kind}, fp long", "text").withColumnRenamed("key", key)


def part(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))


def shared_bytes(difference: Column) -> Column:
    """How many of the eight positional bytes agree."""
    agree = [
        (F.shiftrightunsigned(difference, 8 * i).bitwiseAND(F.lit(0xFF)) == 0).cast("int")
        for i in range(8)
    ]
    return sum(agree[1:], agree[0])


def links(distinct: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Edges ``u, v`` among distinct fingerprints ``fp`` that give the same
    components as all pairs with at most two differing bits."""
    fp = F.col("fp")
    entries = [
        F.struct(
            F.lit(k).alias("k"),
            (F.lit(k << 32) + F.shiftleft(part(fp, a), 16) + part(fp, b)).alias("entry"),
        )
        for k, (a, b) in enumerate(COMBINATIONS)
    ]
    lists = distinct.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.k", "e.entry")
    sizes = lists.groupBy("entry").agg(F.count("*").alias("n")).filter("n > 1")
    sized = store(lists.join(sizes, "entry"), "simhash-lists")

    short = sized.filter(F.col("n") <= longest)
    left = short.select("entry", "k", F.col("fp").alias("u"))
    right = short.select("entry", F.col("fp").alias("v"))
    difference = F.col("u").bitwiseXOR(F.col("v"))
    first = F.lit(len(COMBINATIONS))
    for k, (a, b) in reversed(list(enumerate(COMBINATIONS))):
        first = F.when((part(difference, a) == 0) & (part(difference, b) == 0), k).otherwise(first)
    paired = (
        left.join(right, "entry")
        .filter("u < v")
        .filter(shared_bytes(difference) >= LEAST_BYTES)
        .filter(F.bit_count(difference) <= DISTANCE)
        .filter(first == F.col("k"))
        .select("u", "v")
    )

    long = sized.filter(F.col("n") > longest)
    flips = F.lit(None).cast("array<long>")
    for k, (a, b) in enumerate(COMBINATIONS):
        free = [i for p in range(4) if p not in (a, b) for i in range(16 * p, 16 * p + 16)]
        masks = [0] + [np.uint64(1 << i).astype(np.int64).item() for i in free]
        flips = F.when(F.col("k") == k, F.array(*[F.lit(m).cast("long") for m in masks])).otherwise(flips)
    met = (
        long.select("fp", "entry", F.explode(flips).alias("mask"))
        .groupBy("entry", F.col("fp").bitwiseXOR(F.col("mask")).alias("near"))
        .agg(F.collect_set("fp").alias("fps"))
        .filter(F.size("fps") > 1)
    )
    starred = met.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).filter("u <> v")
    return paired.union(starred)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp, component_id`` of every row.

    ``component_id`` is the smallest key reachable through links (nulls do not
    count; null if no row of the component has a key). Rows with equal
    fingerprints are one node, so copies cost one comparison. Repeated rows come
    out as often as they come in, an empty table gives an empty result, further
    columns are not read.
    """
    rows = store(fingerprints(docs, key, text), "simhash-rows")
    nodes = store(rows.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    labels = components(links(nodes.select("fp")))  # node, root
    of = nodes.join(labels, nodes.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = of.groupBy("root").agg(F.min("least").alias("component_id"))
    found = of.join(smallest, "root").select("fp", "component_id")
    return rows.join(found, "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: that with the smallest key (null keys last).

    Rows are told apart by a number that a written table fixes, under a name the
    table does not use, so rows with null or repeated keys are rows like any others.
    """
    row = unused(docs, "row")
    placed = store(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    own = F.struct(F.col(f"`{key}`").isNull().alias("missing"), F.col(f"`{key}`").alias("key"), F.col(row).alias("row"))
    found = near_duplicates(placed.select(own.alias("own"), F.col(f"`{text}`").alias("text")), "own", "text")
    kept = found.filter("own <=> component_id").select(F.col("own.row").alias(row))
    return only(placed.join(kept, row, "left_semi"), *docs.columns)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
