"""Row counts before and after augmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _counts() -> list[Column]:
    return [
        F.count_if(F.col("copy_id") == 0).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ]


def augment_report(augmented: DataFrame) -> DataFrame:
    """``rows_before`` and ``rows_after`` in one pass: the originals are copy 0."""
    return augmented.agg(*_counts())


def observe_report(augmented: DataFrame, observation: Observation | str) -> DataFrame:
    """``augmented`` itself; the counts arrive in ``observation`` with the job that uses it.

    On a stream give a name, by which ``BatchReports`` gathers the counts of each batch.
    """
    return augmented.observe(observation, *_counts())
