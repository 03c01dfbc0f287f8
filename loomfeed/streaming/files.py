"""A stream of files, each micro-batch of them read in many tasks and written once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loomfeed.operators.checks import REQUIRED
from loomfeed.operators.keys import content_keys
from loomfeed.sources.csv import NA_WORDS, read_examples
from loomfeed.sources.headers import exact_path

# The columns of Spark's binary file source.
_FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"


def write_files_available(
    spark: SparkSession,
    directory: str,
    out: str,
    checkpoint_location: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    na_words: Sequence[str] = NA_WORDS,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start a query that prepares all CSV files now in ``directory``, then stops.

    The stream carries file names alone. A micro-batch gives its names (at most
    ``max_files_per_trigger``) to ``read_examples``, so a big file is cut into many
    tasks, and files may differ in line ends and column order. Rows are keyed by
    content, handed to ``prepare`` and written to ``out/batch=<id>``. A batch that is
    replayed after a failure holds the same files and writes the same folder anew,
    so its rows are there once.

    Run again with the same ``checkpoint_location``, it takes only new files.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_COLUMNS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(directory)
        .select("path")  # contents are not read
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        # the source may list a file twice whose name has an escape in it
        files = sorted({exact_path(r["path"]) for r in batch.collect()})
        if files:
            rows = content_keys(read_examples(batch.sparkSession, files, na_words=na_words).select(*REQUIRED))
            done = prepare(rows) if prepare else rows
            done.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        names.writeStream.foreachBatch(write)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint_location)
        .start()
    )
