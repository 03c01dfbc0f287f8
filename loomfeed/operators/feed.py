"""Training feed as tables: split, epoch order, batch places, collated batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.functions import arrays
from loomfeed.functions.text import as_column
from loomfeed.operators.position import hashed_position
from loomfeed.session import checkpoint

KEY = ("ex_id", "copy_id")


def _digest(seed: int, *parts: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[as_column(p).cast("string") for p in parts]))


def _cut(keys: DataFrame, digits: tuple[int, int], wanted: DataFrame | None, test_size: float):
    """The hash prefix that holds the last wanted row, and how many are wanted in it.

    A prefix of four hex digits has at most 65,536 values, so the histogram and
    the running sum over it are small whatever the number of keys.
    """
    prefix = F.substring("_hash", *digits)
    sizes = keys.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    if wanted is None:
        whole = Window.orderBy("_prefix").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        k = F.ceil(F.sum("_size").over(whole).cast("double") * F.lit(float(test_size)))
    else:
        k = wanted.select("_wanted").scalar()
    reached = sizes.select("_prefix", "_size", F.sum("_size").over(upto).alias("_reached"), k.alias("_k"))
    return reached.filter((F.col("_reached") >= F.col("_k")) & (F.col("_reached") - F.col("_size") < F.col("_k"))).select(
        "_prefix", (F.col("_k") - F.col("_reached") + F.col("_size")).alias("_wanted")
    )


def split(
    df: DataFrame, test_size: float = 0.1, seed: int = 42, key: str = "ex_id", out: str = "split"
) -> DataFrame:
    """Mark exactly ``ceil(n * test_size)`` of the ``n`` distinct examples "test", the rest "train".

    An example is a value of ``key``: rows with one key fall on one side, also
    null keys, so no example is in both parts. Test rows are the first in seeded hash order. The last test row's hash is
    found by two prefix histograms and a sort of the few keys that share eight
    hex digits; then every row compares its own hash with it. The table itself is
    never shuffled, but its keys are read several times: give a stored table.
    All copies of an example fall on the same side.
    """
    originals = df.filter(F.col("copy_id") == 0) if "copy_id" in df.columns else df
    digest = _digest(seed, key)
    keys = originals.select(as_column(key).alias("_key"), digest.alias("_hash")).distinct()
    first = _cut(keys, (1, 4), None, test_size)
    keys = keys.join(F.broadcast(first.select("_prefix")), F.substring("_hash", 1, 4) == F.col("_prefix")).drop("_prefix")
    second = _cut(keys, (5, 4), first, test_size)
    keys = keys.join(F.broadcast(second), F.substring("_hash", 5, 4) == F.col("_prefix"))
    rank = F.row_number().over(Window.orderBy("_hash", "_key"))
    last = keys.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_wanted")).select(F.struct("_hash", "_key"))
    in_test = F.struct(digest.alias("_hash"), as_column(key).alias("_key")) <= last.scalar()
    return df.withColumn(out, F.when(in_test, "test").otherwise("train"))


def split_by_hash(
    df: DataFrame, test_size: float = 0.1, seed: int = 42, key: str = "ex_id", out: str = "split"
) -> DataFrame:
    """Split by a hash threshold: about ``test_size`` of the rows, row by row, also on streams."""
    share = F.conv(F.substring(_digest(seed, key), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return df.withColumn(out, F.when(share < test_size, "test").otherwise("train"))


def epochs(df: DataFrame, n: int = 3, seed: int = 42, key: Sequence[str] = KEY) -> DataFrame:
    """Every row once per epoch, with its place in that epoch's own shuffled order.

    Adds ``epoch`` (0-based) and ``position`` (dense, 0-based per epoch). Rows
    are told apart by a number that a checkpoint fixes, never by their key, so
    rows with equal or null keys are kept and placed like any others. Places are
    computed on keys and numbers alone; the other columns move once, in the join
    back on that number.
    """
    rows = checkpoint(df.withColumn("_row", F.monotonically_increasing_id()))
    keys = rows.select("_row", *key).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    placed = hashed_position(keys, _digest(seed, "epoch", *key), [*key, "_row"], "epoch")
    if set(df.columns) == set(key):
        return placed.select(*key, "epoch", "position")
    return rows.join(placed.select("_row", "epoch", "position"), "_row").drop("_row")


def assign_batches(
    df: DataFrame, batch: int = 2, world: int = 1, accum: int = 2, position: str = "position"
) -> DataFrame:
    """Place in the feed: ``slot`` in the micro-batch, ``rank``, ``micro`` and optimizer ``step``.

    One optimizer step takes ``batch * world * accum`` rows; a last partial batch is kept.
    """
    return df.withColumns(
        {
            "slot": F.expr(f"cast({position} % {batch} as int)"),
            "rank": F.expr(f"cast(({position} div {batch}) % {world} as int)"),
            "micro": F.expr(f"{position} div {batch * world}"),
            "step": F.expr(f"{position} div {batch * world * accum}"),
        }
    )


def collate(df: DataFrame, pad_id: int = 0) -> DataFrame:
    """One row per micro-batch, its rows in slot order; labels made from the ids.

    A group has at most the batch size of rows, so every task stays small.
    """
    row = F.struct("slot", *[F.col(k) for k in KEY], "input_ids", "attention_mask")
    grouped = df.groupBy("epoch", "step", "micro", "rank").agg(F.sort_array(F.collect_list(row)).alias("_rows"))

    def each(name: str) -> Column:
        return F.transform("_rows", lambda r: r[name])

    return grouped.select(
        "epoch", "step", "micro", "rank",
        *[each(k).alias(k) for k in KEY],
        each("input_ids").alias("input_ids"),
        each("attention_mask").alias("attention_mask"),
        F.transform("_rows", lambda r: arrays.mask_labels(r["input_ids"], pad_id)).alias("labels"),
    )
