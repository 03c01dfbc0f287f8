"""Parquet sink for prepared examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_examples(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("split",),
    mode: str = "errorifexists",
    files_per_folder: int | None = None,
    spread_by: Sequence[str] = ("ex_id", "copy_id"),
) -> None:
    """Write ``df`` as Parquet, one folder per value of ``partition_by``.

    By default no shuffle is added: each task writes its own file to each
    folder it has rows for, so a folder that holds most rows is still written
    by all tasks. For many folders, such as one per epoch and rank, give
    ``files_per_folder``: rows are then brought together per folder and per
    hash of ``spread_by``, so the number of files does not grow with the number
    of tasks and a big folder is still shared out.
    """
    if files_per_folder:
        share = F.pmod(F.xxhash64(*spread_by), F.lit(files_per_folder))
        df = df.repartition(*partition_by, share)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
