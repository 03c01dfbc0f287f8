"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeed.llm.common import store

MAX_ROUNDS = 100
#: Edges of a written file, about. What a round leaves is small against its shuffles.
FILE_EDGES = 1 << 18


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v``), root the smallest node reachable.

    Every round is two grouped minima and two joins over the remaining edges,
    written to the shared folder. Long chains shrink to stars in a logarithmic
    number of rounds.
    """
    now = store(_tidy(edges), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == seen or not found[0]:
            return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
                now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        seen = found
        files = 1 + found[0] // FILE_EDGES
        now = store(_small_star(_large_star(now)).coalesce(files), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller node in ``u``."""
    return (
        edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Join the larger neighbours of each node to its smallest neighbour or itself."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _tidy(both.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join the smaller neighbours of each node, and the node, to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return _tidy(moved.union(least.select(F.col("m").alias("u"), "v")))
