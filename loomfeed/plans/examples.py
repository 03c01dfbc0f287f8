"""The example table derived from a table of conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Turns of one conversation that one task orders at a time.
TURNS_PER_CHUNK = 1024


def examples_from_conversations(
    spark: SparkSession, sf_dir: str, turns_per_chunk: int = TURNS_PER_CHUNK
) -> DataFrame:
    """``(ex_id, instruction, input, output)``: a user turn directly followed by an assistant turn.

    A conversation is cut into chunks of turns, so that a very long one is
    ordered by many tasks. The turn after a chunk's last one, and the system
    text of the conversation, come from a table of one row per chunk, joined on
    the same key the turns are already partitioned by. ``ex_id`` is
    ``<conv_id>-<turn>``. Turns without a conversation are one conversation
    without a system text.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").withColumn(
        "_chunk", F.floor(F.col("turn") / turns_per_chunk)
    )
    said = F.struct("role", "text")
    chunks = turns.groupBy("conv_id", "_chunk").agg(
        F.min_by(said, "turn").alias("_first"),
        F.min(F.when(F.col("role") == "system", F.col("text"))).alias("_system"),
    )
    conversation = Window.partitionBy("conv_id")
    chunks = chunks.select(
        F.col("conv_id").alias("_conv"),
        F.col("_chunk").alias("_part"),
        F.lead("_first").over(conversation.orderBy("_chunk")).alias("_after"),
        F.min("_system").over(conversation).alias("_system"),
    )
    inside = Window.partitionBy("conv_id", "_chunk").orderBy("turn")
    pairs = (
        turns.withColumn("_next", F.lead(said).over(inside))
        .join(chunks, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_chunk").eqNullSafe(F.col("_part")))
        .withColumn("_next", F.coalesce("_next", "_after"))
        .filter((F.col("role") == "user") & (F.col("_next.role") == "assistant"))
    )
    system = F.when(F.col("conv_id").isNotNull(), F.col("_system"))
    return pairs.select(
        F.concat_ws("-", "conv_id", "turn").alias("ex_id"),
        F.when(F.col("conv_id") % 5 == 0, F.col("text"))
        .otherwise(F.concat(F.lit("Instruction: "), "text"))
        .alias("instruction"),
        F.when(system.isNotNull(), F.concat(F.lit("Input: "), system, F.lit(" Input: "), system))
        .when(F.col("conv_id") % 7 == 0, F.lit(""))
        .alias("input"),
        F.concat(F.lit("Output: "), F.col("_next.text")).alias("output"),
    )
