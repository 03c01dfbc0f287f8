"""The same work over a directory that CSV files arrive in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loomfeed.operators.checks import REQUIRED
from loomfeed.operators.keys import content_keys
from loomfeed.sources.csv import NA_WORDS, CsvLayout, clean_rows, csv_layout


def stream_examples(
    spark: SparkSession,
    directory: str,
    layout: CsvLayout | None = None,
    na_words: Sequence[str] = NA_WORDS,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of ``(ex_id, instruction, input, output)`` keyed by content.

    The layout of the files is read from those already in ``directory``, or
    given, e.g. ``CsvLayout(("instruction", "input", "output"))``. A file with
    another header fails the query. No state is kept, so rows of equal content
    get the same key.
    """
    layout = (layout or csv_layout(spark, directory)).require(REQUIRED)
    reader = spark.readStream.options(**layout.options).schema(layout.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return content_keys(clean_rows(reader.csv(directory), na_words).select(*REQUIRED))


def write_available(stream: DataFrame, path: str, checkpoint_location: str) -> StreamingQuery:
    """Start a query that appends all input now present to Parquet, then stops.

    Run again with the same ``checkpoint_location``, it takes only new files.
    """
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint_location)
        .start(path)
    )
