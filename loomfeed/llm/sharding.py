"""Sharding by a hierarchical weighted hash tree, in built-in expressions only.

Leaves are shards, below racks, below regions. A row's draw at a leaf is the
exponential ``-ln(u) / weight`` with ``u`` hashed from the row's key and the
leaf. A subtree's draw is the smallest of its leaves, which is exponential with
the subtree's total weight; a row descends to the child with the smallest draw
at each level. So a shard gets rows in proportion to its weight, and a changed
weight changes the draws on its own path alone: rows move only into subtrees
that grew or out of subtrees that shrank, and one more shard takes rows only
into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.llm.common import store

#: Rows that are numbered in one group.
BUCKET_ROWS = 50_000
SHARDS_A_RACK = 4
RACKS_A_REGION = 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, weights: dict[int, float] | None = None) -> list[Leaf]:
    """Shards 0 and up, four to a rack, two racks to a region."""
    racks = [s // SHARDS_A_RACK for s in range(shards)]
    return [Leaf(r // RACKS_A_REGION, r, s, (weights or {}).get(s, 1.0)) for s, r in enumerate(racks)]


def draw(key: Column, leaf: Leaf) -> Column:
    """The row's exponential draw at a leaf, from 53 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(leaf.shard)), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(uniform) / F.lit(float(leaf.weight))


def _smallest(names: list[str]) -> Column:
    columns = [F.col(n) for n in names]
    return F.least(*columns) if len(columns) > 1 else columns[0]


def _descend(options: list[tuple[int, str]], best: Column) -> Column:
    """The child whose draw is the smallest; equal draws go to the first child."""
    out = F.lit(None).cast("int")
    for child, name in reversed(options):
        out = F.when(F.col(name) == best, child).otherwise(out)
    return out


def assign(docs: DataFrame, leaves: list[Leaf], key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row. A null key hashes like any value; a leaf
    of weight 0 or less takes nothing."""
    leaves = [x for x in leaves if x.weight > 0]
    if not leaves:
        raise ValueError("no shard has a weight")
    names = [f"`{n}`" for n in docs.columns]
    at = {x: f"_leaf_{x.shard}" for x in leaves}
    racks = sorted({(x.region, x.rack) for x in leaves})
    regions = sorted({x.region for x in leaves})
    rows = docs.select(*names, *[draw(F.col(key), x).alias(n) for x, n in at.items()])
    rows = rows.select(
        "*", *[_smallest([n for x, n in at.items() if x.rack == k]).alias(f"_rack_{k}") for _, k in racks]
    )
    rows = rows.select(
        "*", *[_smallest([f"_rack_{k}" for r, k in racks if r == g]).alias(f"_region_{g}") for g in regions]
    )
    best = _smallest([f"_region_{g}" for g in regions])
    rows = rows.withColumn("_region", _descend([(g, f"_region_{g}") for g in regions], best))
    rack = F.lit(None).cast("int")
    for g in regions:
        inside = _descend([(k, f"_rack_{k}") for r, k in racks if r == g], F.col(f"_region_{g}"))
        rack = F.when(F.col("_region") == g, inside).otherwise(rack)
    rows = rows.withColumn("_rack", rack)
    found = F.lit(None).cast("int")
    for _, k in racks:
        inside = _descend([(x.shard, n) for x, n in at.items() if x.rack == k], F.col(f"_rack_{k}"))
        found = F.when(F.col("_rack") == k, inside).otherwise(found)
    return rows.select(*names, found.alias(shard))


def number(rows: DataFrame, shard: str = "shard", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``slot``: 0 and up in each shard, without gaps, any rows.

    Rows are dealt to buckets by a hash of all their columns and numbered there;
    bucket counts, which are few, give each bucket its first slot. No task holds
    a whole shard, and equal rows get slots of their own.
    """
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in rows.columns]), F.lit(buckets)).cast("int")
    dealt = rows.withColumn("_bucket", spread)
    counts = dealt.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    order = Window.partitionBy(shard, "_bucket").orderBy(*[F.col(f"`{n}`") for n in rows.columns])
    ranked = dealt.withColumn("_nth", F.row_number().over(order) - 1)
    return ranked.join(first, [shard, "_bucket"]).select(
        *[F.col(f"`{n}`") for n in rows.columns], (F.col("_first") + F.col("_nth")).cast("long").alias("slot")
    )


def shard_documents(
    docs: DataFrame, shards: int, grown: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1. The text is read
    once and reduced to numbers before anything moves. Repeated rows stay; an
    empty table gives none; further columns are not read.
    """
    data = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{key}`"), (F.length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    placed = assign(assign(rows, tree(shards), key), tree(grown), key, "grown_shard")
    return number(store(placed, "shards")).withColumn("law", F.lit("key"))
