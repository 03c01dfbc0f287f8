"""Parquet files of planned size, visible through a manifest that is moved into place last.

The bytes of a row's values come from built-in expressions. One aggregation gives the
bytes per folder, and so the number of files; a uniform hash of the row number deals
rows to files, so that a folder with most rows has the most files and equal rows are
spread as well. The table is shuffled once. Where a second scan packs rows otherwise,
rows meet other files, but each still meets exactly one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeed.functions.text import quoted
from loomfeed.sources.shards import place_of

MANIFEST = "_manifest.json"
FILE_BYTES = 256 << 20
#: Folders whose plan is broadcast (some 30 bytes each and the values that name them); more are joined.
MOST_FOLDERS = 10_000
SPACE = 1 << 31

WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values before compression: text by its UTF-8 bytes, numbers and
    arrays of them by their width, other nested values by their JSON; nulls have none."""
    sizes = [F.lit(1).cast("long")]
    for field in schema.fields:
        column, kind = F.col(quoted(field.name)), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.octet_length(column)
        elif type(kind) in WIDTHS:
            size = F.when(column.isNotNull(), WIDTHS[type(kind)])
        elif isinstance(kind, T.ArrayType) and type(kind.elementType) in WIDTHS:
            size = F.when(column.isNotNull(), F.size(column).cast("long") * WIDTHS[type(kind.elementType)])
        else:
            size = F.octet_length(F.to_json(F.struct(column)))
        sizes.append(F.coalesce(size, F.lit(0)).cast("long"))
    return reduce(lambda a, b: a + b, sizes)


def planned(df: DataFrame, partition_by: Sequence[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """``row`` (all columns as a struct), ``folder`` (a number) and ``file`` (a number in the
    folder) of each row."""
    if file_bytes < 1:
        raise ValueError("file_bytes must be positive")
    names = [f"_{i}" for i in range(len(partition_by))]
    by = [F.col(quoted(c)).alias(n) for c, n in zip(partition_by, names, strict=True)]
    rows = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"), *by)
    totals = df.select(row_bytes(df.schema).alias("bytes"), *by).groupBy(*names).agg(F.sum("bytes").alias("bytes"))
    # a row per folder: each has its values for a name, which tells nulls from texts
    named = totals.withColumn("folder", F.sha2(F.to_json(F.struct(F.lit(0).alias("at"), *names)), 256))
    files = F.greatest(F.lit(1), F.round(F.col("bytes") / file_bytes)).cast("long")
    plan = named.select("folder", files.alias("files")).filter(F.col("bytes").isNotNull())
    few = len(plan.limit(MOST_FOLDERS + 1).select("files").collect()) <= MOST_FOLDERS
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPACE))
    rows = rows.select(
        "row", F.sha2(F.to_json(F.struct(F.lit(0).alias("at"), *names)), 256).alias("folder"), draw.alias("draw")
    )
    dealt = rows.join(F.broadcast(plan) if few else plan, "folder")
    # floor(draw * files / SPACE) without leaving whole numbers
    return dealt.select("row", "folder", F.shiftright(F.col("draw") * F.col("files"), 31).alias("file"))


def write_planned(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("split",), file_bytes: int = FILE_BYTES
) -> None:
    """Write ``df`` as Parquet files of about ``file_bytes`` of values, one file per task group.

    A folder of ``n`` times that size gets ``n`` files, at least one; rows larger than the
    target stay whole. A path that holds a manifest is refused. The files of a failed or
    repeated write lie in a folder of their own that no manifest names. An empty table
    has a manifest and no files. The driver holds a name and a size for each file.
    """
    system, place = place_of(path)
    if system.get_file_info(f"{place}/{MANIFEST}").type != fs.FileType.NotFound:
        raise FileExistsError(f"there is a table at {path}")
    spark, folder = df.sparkSession, f"data-{uuid.uuid4().hex}"
    rows = planned(df, partition_by, file_bytes).repartition("folder", "file")
    # the columns stay in one struct, so no name of theirs meets those of the folders
    rows.write.partitionBy("folder", "file").parquet(f"{path}/{folder}")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = listed.option("pathGlobFilter", "*.parquet").load(f"{path}/{folder}").select("path", "length")
    files = [[f"{folder}/{r['path'].split(folder + '/', 1)[1]}", r["length"]] for r in found.collect()]
    # a write of no rows leaves one file at the top, for the schema alone
    files = sorted(f for f in files if "/folder=" in f[0])
    system.create_dir(place, recursive=True)
    attempt = f"{place}/_{MANIFEST}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt, compression=None) as out:
        out.write(json.dumps({"schema": df.schema.jsonValue(), "files": files}).encode())
    system.move(attempt, f"{place}/{MANIFEST}")


def manifest_of(path: str) -> dict:
    system, place = place_of(path)
    if system.get_file_info(f"{place}/{MANIFEST}").type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no committed table at {path}")
    with system.open_input_stream(f"{place}/{MANIFEST}", compression=None) as source:
        return json.loads(source.read())


def read_planned(spark: SparkSession, path: str) -> DataFrame:
    """The table as its manifest names it; other files below ``path`` are not seen."""
    found = manifest_of(path)
    schema = T.StructType.fromJson(found["schema"])
    if not found["files"]:
        return spark.createDataFrame([], schema)
    files = [f"{path}/{name}" for name, _ in found["files"]]
    stored = spark.read.schema(T.StructType([T.StructField("row", schema)])).parquet(*files)
    return stored.select(*[F.col(f"row.{quoted(n)}").alias(n) for n in schema.names])
