"""Schema checks made while the plan is built, before any job runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

REQUIRED = ("instruction", "input", "output")


def missing_columns(present: Sequence[str], required: Sequence[str] = REQUIRED) -> list[str]:
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """``df`` itself, or ``ValueError`` naming the columns it lacks."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise ValueError(f"missing required columns {missing}; needed are {list(required)}")
    return df
