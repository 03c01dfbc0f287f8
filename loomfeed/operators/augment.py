"""Replication and keyword variation."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeed.functions.text import as_column, choose, replace_all, replace_first, text_of
from loomfeed.operators.checks import REQUIRED
from loomfeed.operators.position import ordered_position

logger = logging.getLogger(__name__)

# The variation words shipped with each generation.
SLOT_WORDS = ("Instruction:", "Task:", "Input:", "Context:", "Output:", "Response:")
COLUMN_WORDS = {
    "instruction": ("Instruction:", "Task:", "Objective:"),
    "input": ("Input:", "Context:", "Given:"),
    "output": ("Output:", "Response:", "Result:"),
}


def replicate(df: DataFrame, n: int, out: str = "copy_id") -> DataFrame:
    """``n`` copies of every row, originals included, numbered from 0.

    One scan that streams the copies, instead of a union of ``n`` scans.
    """
    if n <= 1:
        return df.withColumn(out, F.lit(0))
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def renumber(df: DataFrame, order: str = "ex_id", out: str = "row_index") -> DataFrame:
    """Dense copy-major index: all rows by ``copy_id``, then ``order`` (nulls first).

    Every row gets a number of its own, also where keys repeat.
    """
    return ordered_position(df, ["copy_id", order], out)


def _row_draw(name: str, key: str) -> list:
    return [as_column(key), F.col("copy_id"), F.lit(name)]


def vary_slots(
    df: DataFrame, words: Sequence[str] = SLOT_WORDS, seed: int = 42, key: str = "ex_id"
) -> DataFrame:
    """First-generation variation, over one flat word list read by position.

    The keyword of the i-th required column is word ``2i``; its replacements are
    *all* words after that. Every occurrence is replaced, so a present keyword
    never stays. The word is drawn before replacing: one replacement per cell
    instead of one per candidate, with the same result.
    """
    if len(words) < 2 * len(REQUIRED):
        raise ValueError(f"need at least {2 * len(REQUIRED)} words, got {len(words)}")
    varied = {}
    for i, name in enumerate(REQUIRED):
        word = choose(list(words[2 * i + 1 :]), seed, _row_draw(name, key))
        varied[name] = replace_all(name, words[2 * i], word)
    return df.withColumns(varied)


def vary_columns(
    df: DataFrame,
    variations: Mapping[str, Sequence[str]] | None = None,
    seed: int = 42,
    apply: bool = True,
    null_literal: str | None = None,
    key: str = "ex_id",
) -> DataFrame:
    """Second-generation variation: ``{column: [keyword, replacement, ...]}``.

    In each listed column the first occurrence of the keyword becomes one of
    the replacements. A listed column that is absent is skipped with a warning;
    one with fewer than two words is only cast to text. ``null_literal="nan"``
    writes missing cells of listed columns as that text; by default they stay
    missing.
    """
    variations = COLUMN_WORDS if variations is None else variations
    if not apply or not variations:
        return df
    varied = {}
    for name, listed in variations.items():
        if name not in df.columns:
            logger.warning("variation column %r is not in the table, skipped", name)
            continue
        text = text_of(name, null_literal)
        if listed and len(listed) >= 2:
            word = choose(list(listed[1:]), seed, _row_draw(name, key))
            text = replace_first(text, listed[0], word)
        varied[name] = text
    return df.withColumns(varied) if varied else df


def augment(
    df: DataFrame,
    apply: bool = False,
    repeat_count: int = 1,
    variations: Mapping[str, Sequence[str]] | None = None,
    seed: int = 42,
    null_literal: str | None = None,
    key: str = "ex_id",
) -> DataFrame:
    """Second-generation augmentation with its switches.

    Off by default, and nothing to do when there is neither a repeat nor a
    variation; ``copy_id`` is then 0 throughout.
    """
    variations = variations or {}
    if not apply or (repeat_count <= 1 and not variations):
        return replicate(df, 1)
    return vary_columns(replicate(df, repeat_count), variations, seed, True, null_literal, key)
