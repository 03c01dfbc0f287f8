"""Column expressions over text: keyword tests, replacements and seeded draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(col: ColumnOrName) -> Column:
    return col if isinstance(col, Column) else F.col(quoted(col))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_of(col: ColumnOrName, null_literal: str | None = None) -> Column:
    """``col`` as text; a missing value stays missing or becomes ``null_literal``."""
    text = as_column(col).cast("string")
    return text if null_literal is None else F.coalesce(text, F.lit(null_literal))


def has_input(col: ColumnOrName) -> Column:
    """True when the text is neither missing nor empty; blanks count as text."""
    text = as_column(col)
    return F.coalesce(text != "", F.lit(False))


def contains_keyword(col: ColumnOrName, keyword: str) -> Column:
    """Literal, case-sensitive containment; missing text contains nothing."""
    return F.coalesce(F.instr(as_column(col), keyword) > 0, F.lit(False))


def replace_all(col: ColumnOrName, keyword: str, value: ColumnOrName) -> Column:
    """Every occurrence of ``keyword`` replaced by ``value`` (text, or a column)."""
    text = as_column(col)
    value = F.lit(value) if isinstance(value, str) else value
    if keyword:
        return F.replace(text, F.lit(keyword), value)
    # an empty keyword occurs before every character and at the end
    between = F.call_function("concat_ws", value, F.split(text, ""))
    return F.when(text == "", value).otherwise(F.concat(value, between, value))


def replace_first(col: ColumnOrName, keyword: str, value: ColumnOrName) -> Column:
    """The first occurrence of ``keyword`` replaced by ``value``."""
    text = as_column(col)
    value = F.lit(value) if isinstance(value, str) else value
    at = F.instr(text, keyword)
    return F.when(at > 0, F.overlay(text, value, at, F.lit(len(keyword)))).otherwise(text)


def candidates(col: ColumnOrName, keyword: str, values: Sequence[str]) -> Column:
    """Array of the text under each replacement, in the order of ``values``."""
    return F.transform(
        F.array(*[F.lit(v) for v in values]), lambda v: replace_all(col, keyword, v)
    )


def draw(n: int, seed: int, keys: Sequence[Column]) -> Column:
    """A uniform index in ``[0, n)`` fixed by the seed and the row's key columns.

    Hash-based, so the value does not depend on partitioning and a retried task
    draws the same.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(n)


def choose(values: Sequence[str | Column], seed: int, keys: Sequence[Column]) -> Column:
    """One of ``values``, each equally likely, fixed by seed and keys."""
    items = [v if isinstance(v, Column) else F.lit(v) for v in values]
    if not items:
        raise ValueError("nothing to choose from")
    if len(items) == 1:
        return items[0]
    return F.element_at(F.array(*items), (draw(len(items), seed, keys) + 1).cast("int"))


def content_key(columns: Sequence[str]) -> Column:
    """128-bit hash of the named columns; parts carry their length, nulls a mark."""
    parts = []
    for name in columns:
        text = text_of(name)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*parts))
