"""Column expressions over token arrays: cut, pad, mask, label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED_LABEL = -100

# The whitespace that separates words.
_SPACES = "[ \n\t\r]+"


def words(text: Column, max_words: int | None = None) -> Column:
    """Words of ``text`` in order, none for a missing one; only the first ``max_words`` where given.

    With ``max_words`` the splitter stops once it has that many words, a possible
    empty piece before the first one and the unsplit rest; the result is the same
    as that of a full split followed by a slice.
    """
    text = F.coalesce(text, F.lit(""))
    if max_words is None:
        return F.array_remove(F.split(text, _SPACES), "")
    return F.slice(F.array_remove(F.split(text, _SPACES, max_words + 2), ""), 1, max_words)


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def _filled(value: int, times: Column) -> Column:
    return F.array_repeat(F.lit(value).cast("int"), times.cast("int"))


def _joined(body: Column, fill: Column, side: str) -> Column:
    if side not in ("left", "right"):
        raise ValueError(f"side must be 'left' or 'right', not {side!r}")
    return F.concat(body, fill) if side == "right" else F.concat(fill, body)


def pad(ids: Column, length: Column | int, pad_id: int, side: str = "right") -> Column:
    """``ids`` filled up to ``length`` with ``pad_id``."""
    length = F.lit(length) if isinstance(length, int) else length
    return _joined(ids, _filled(pad_id, length - F.size(ids)), side)


def attention_mask(ids: Column, length: Column | int, side: str = "right") -> Column:
    """1 for each of the unpadded ``ids``, 0 for each filled place."""
    length = F.lit(length) if isinstance(length, int) else length
    return _joined(_filled(1, F.size(ids)), _filled(0, length - F.size(ids)), side)


def padded_labels(ids: Column, length: Column | int, pad_id: int, side: str = "right") -> Column:
    """Labels of the unpadded ``ids`` after padding; filled places need no look."""
    length = F.lit(length) if isinstance(length, int) else length
    return _joined(mask_labels(ids, pad_id), _filled(IGNORED_LABEL, length - F.size(ids)), side)


def mask_labels(ids: Column, pad_id: int) -> Column:
    """A copy of ``ids`` with ``pad_id`` turned into the ignored label."""
    return F.transform(
        ids, lambda x: F.when(x == pad_id, F.lit(IGNORED_LABEL)).otherwise(x).cast("int")
    )
