"""Shuffled places of numbered rows as a projection: a keyed permutation.

A row number below ``total`` is written as two digits of bases near the square
root of ``total``. Rounds add to each digit in turn a hash of the seed, the epoch
and the other digit, which can be undone, so the map is one to one on all pairs of
digits. The few pairs beyond ``total`` are mapped again until they fall below it
(cycle walking), which keeps it one to one on the rows.

A place needs no sort, no shuffle and no other row. The inverse tells which row
is at a place, so a feed can be resumed, or read, at any step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeed.functions.text import as_column

ROUNDS = 4
# A walk leaves the few numbers beyond the total at once, but for a chance of about
# 1 / sqrt(total) a step; small totals have fewer such numbers than this.
LONGEST_WALK = 64


def bases(total: int) -> tuple[int, int]:
    """The bases of the two digits: their product is the least such that covers ``total``."""
    left = math.isqrt(max(total, 1) - 1) + 1
    return left, -(-max(total, 1) // left)


def _hash(seed: int, epoch: Column, turn: Column, digit: Column) -> Column:
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in (epoch, turn, digit)])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def _rounds(number: Column, total: int, seed: int, epoch: Column, back: bool) -> Column:
    left, right = bases(total)
    digits = F.struct(
        F.call_function("div", number, F.lit(right).cast("long")).alias("l"), (number % right).cast("long").alias("r")
    )
    sign = -1 if back else 1

    def turn(d: Column, i: Column) -> Column:
        l = F.pmod(d["l"] + sign * _hash(seed, epoch, i, d["r"]), F.lit(left).cast("long"))  # noqa: E741
        r = F.pmod(d["r"] + sign * _hash(seed, epoch, i, d["l"]), F.lit(right).cast("long"))
        return F.when(i % 2 == 0, F.struct(l.alias("l"), d["r"].alias("r"))).otherwise(
            F.struct(d["l"].alias("l"), r.alias("r"))
        )

    order = range(ROUNDS)[::-1] if back else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(i) for i in order]), digits, turn, lambda d: d["l"] * right + d["r"])


def _permuted(number: Column, total: int, seed: int, epoch: Column, back: bool) -> Column:
    steps = F.sequence(F.lit(1), F.lit(LONGEST_WALK))
    walked = F.aggregate(
        steps,
        _rounds(number, total, seed, epoch, back),
        lambda x, _: F.when(x < total, x).otherwise(_rounds(x, total, seed, epoch, back)),
    )
    outside = F.raise_error(F.lit("a row number is not below the total, or a walk has not ended")).cast("long")
    # bound by a one-element list, so that it is computed once
    checked = F.transform(F.array(walked), lambda x: F.when(x < total, x).otherwise(outside))
    inside = (number >= 0) & (number < total)
    return F.when(number.isNull(), None).when(inside, F.get(checked, F.lit(0))).otherwise(outside)


def place_of(row: Column | str, total: int, seed: int = 42, epoch: Column | int = 0) -> Column:
    """The place of row number ``row`` (0 to ``total`` - 1) in the epoch's order; null for null."""
    return _permuted(as_column(row).cast("long"), total, seed, _epoch(epoch), False)


def row_at(place: Column | str, total: int, seed: int = 42, epoch: Column | int = 0) -> Column:
    """The row number at a place of the epoch's order: the inverse of :func:`place_of`."""
    return _permuted(as_column(place).cast("long"), total, seed, _epoch(epoch), True)


def _epoch(epoch: Column | int) -> Column:
    return F.lit(epoch) if isinstance(epoch, int) else epoch


def keyed_epochs(
    df: DataFrame, n: int = 3, total: int | None = None, seed: int = 42, row: str = "row_index"
) -> DataFrame:
    """Every row once per epoch, with its ``position`` in that epoch's own order.

    ``row`` numbers the rows from 0 without gaps, as ``ingest_examples`` and
    ``renumber`` do. One projection, whatever the number of epochs. ``total`` is
    counted if it is not given.
    """
    total = df.count() if total is None else total
    each = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return each.withColumn("position", place_of(row, total, seed, F.col("epoch")))


def from_step(
    df: DataFrame, step: int, batch: int = 2, world: int = 1, accum: int = 2, position: str = "position"
) -> DataFrame:
    """What an epoch still feeds when training goes on at optimizer step ``step``."""
    return df.filter(as_column(position) >= step * batch * world * accum)
