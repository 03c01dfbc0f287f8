"""Row keys for tables that bring none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeed.functions.text import content_key, quoted

# Copies of one row made by a single task.
COPIES_PER_TASK_ROW = 65_536


def content_keys(df: DataFrame, key: str = "ex_id") -> DataFrame:
    """Key each row by its content alone: shuffle-free, works on streams.

    Rows with equal content get equal keys.
    """
    return df.withColumn(key, content_key(df.columns))


def row_keys(df: DataFrame, key: str = "ex_id", chunk: int = COPIES_PER_TASK_ROW) -> DataFrame:
    """Key each row uniquely as ``<content hash>-<number among equal rows>``.

    Equal rows are counted with map-side combining and written out again from
    their count. A row with more than ``chunk`` copies is first cut into
    chunks that are spread over the cluster, so no task holds all copies of a
    frequent row.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    keyed = counted.select(*columns, "_n", content_key(df.columns).alias("_h"))

    def written(rows: DataFrame, numbers: Column) -> DataFrame:
        out = rows.select(*columns, "_h", F.explode(numbers).alias("_i"))
        return out.select(*columns, F.concat_ws("-", "_h", "_i").alias(key))

    few = written(keyed.filter(F.col("_n") <= chunk), F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    chunks = keyed.filter(F.col("_n") > chunk).select(
        *columns, "_n", "_h", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(chunk).cast("long"))).alias("_from")
    )
    spread = chunks.repartition("_h", "_from")
    many = written(spread, F.sequence(F.col("_from"), F.least(F.col("_from") + chunk, F.col("_n")) - 1))
    return few.unionByName(many)
