"""Dense 0-based positions without sorting everything in one task.

Rows are numbered in place, with all their columns: nothing is joined back on a
key, so keys may repeat or be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.functions.text import quoted
from loomfeed.session import checkpoint

# Rows that one window group numbers, about.
BUCKET_ROWS = 65_536

_ROW_BITS = 33  # monotonically_increasing_id: low 33 bits count rows in a partition


def ordered_position(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """``df`` with the position of each row in ``order``; rows of equal keys in any order.

    Rows are range-partitioned, sorted per partition and numbered there; the
    start of each partition is the sum of the sizes before it. A row number
    breaks ties, so equal keys are spread over partitions too. Range bounds are
    sampled, so the numbered rows are checkpointed before they are read twice.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [quoted(c) for c in order] + ["_tie"]
    numbered = checkpoint(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    ).select(
        *[F.col(quoted(c)) for c in df.columns],
        F.shiftright("_at", _ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # one row per range partition
    joined = numbered.join(F.broadcast(starts), "_part")
    return joined.withColumn(out, F.col("_start") + F.col("_row")).select(
        *[F.col(quoted(c)) for c in df.columns], out
    )


def hashed_position(
    df: DataFrame,
    digest: Column,
    order: Sequence[str],
    group: str,
    out: str = "position",
) -> DataFrame:
    """``df`` with the position of each row by (``digest``, ``order``) within its ``group``.

    ``digest`` is a uniform hex hash, so its leading digits cut the rows into
    equal buckets that are already in order: no sampling, no sort over all
    rows. A row's position is the size of the buckets before its own plus its
    rank inside it. The number of buckets follows the number of rows. ``order``
    must tell rows apart; its last column should be a row number.
    """
    rows, digits = df.count(), 1
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    prefix = F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")
    hashed = df.withColumn("_bucket", prefix).withColumn("_hash", F.unhex(digest))
    sizes = hashed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(group, "_bucket").orderBy("_hash", *order)
    ranked = hashed.withColumn("_rank", F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, [group, "_bucket"])
        .withColumn(out, F.col("_start") + F.col("_rank"))
        .drop("_hash", "_bucket", "_rank", "_start")
    )
