"""Reliable storage for cut lineage, and session settings that suit the jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent *and* the
    master is ``local`` or ``local[...]``, one process on one machine, as in tests;
    a ``local-cluster`` has several processes and needs the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that every executor can reach"
        )
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="loomfeed-")
    return _local_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and go on from there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def builder(app_name: str = "loomfeed") -> SparkSession.Builder:
    """A session builder with the settings the operators are tuned for."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # prompts can be long, so Arrow batches are kept small
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
    )
