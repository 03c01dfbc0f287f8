"""Nearest neighbours by inner product: probed lists and an adaptive dimension scan.

Vectors get one more coordinate that gives all the same norm, which makes the
largest inner product the smallest distance, and are turned by a random
rotation, so that any leading coordinates are a fair sample of the distance.
Lists are fitted by k-means on a bounded sample and every vector is put into its
nearest list. A query probes its nearest lists; within each the coordinates are
scanned in column blocks, and after each block the candidates whose partial
distance fails a hypothesis test against the query's limit are given up. The
limit is the distance of the 2(k+1)-th best sample vector in the probed lists,
an upper bound of the k-th best there. Survivors are scored exactly on the original vectors.

Equal vectors are one entry. An entry carries its ``k + 1`` smallest ids; no
further copy can be in a result of ``k``, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.llm.common import store

K = 20
#: Vectors that rotation, lists, probes and limits are fitted on, at most.
SAMPLE = 8_192
#: Sample queries that the number of probes is measured with.
TRIALS = 256
#: Recall that the probes must reach on the sample.
RECALL = 0.97
LIST_ROWS = 512
MOST_LISTS = 256
#: Entries and queries that meet in one task.
BLOCK_ROWS, CHUNK_ROWS = 2_048, 4_096
COLUMNS = 16
#: Strictness of the test: standard deviations a partial distance may lie above its share.
DEVIATIONS = 2.1
PAIRS_AT_ONCE = 1 << 20


@dataclass
class Index:
    """What was fitted: rotation, norm, list centres, sample and probes."""

    rotation: np.ndarray
    norm: float
    centers: np.ndarray
    sample: np.ndarray
    probes: int

    def turned(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        squares = (vectors**2).sum(axis=1)
        last = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.norm**2 - squares, 0))
        return np.column_stack((vectors, last)) @ self.rotation

    def nearest_list(self, turned: np.ndarray) -> np.ndarray:
        return _distances(turned, self.centers).argmin(axis=1)

    def limit(self, queries: np.ndarray, probes: list[list[int]], k: int) -> np.ndarray:
        """Distance of each query's k-th best sample vector in the lists it probes; infinite if there are fewer."""
        if len(self.sample) < k:
            return np.full(len(queries), np.inf)
        own = self.nearest_list(self.sample)
        out = np.empty(len(queries))
        for i, lists in enumerate(probes):
            near = _distances(queries[i : i + 1], self.sample[np.isin(own, lists)])[0]
            out[i] = np.partition(near, k - 1)[k - 1] if len(near) >= k else np.inf
        return out * (1 + 1e-9) + 1e-12


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0)


def fit(vectors: np.ndarray, norm: float, entries: int, k: int, seed: int = 7) -> Index:
    """Fit on at most ``SAMPLE`` distinct vectors."""
    rng = np.random.default_rng(seed)
    size = vectors.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
    index = Index(rotation, norm, np.zeros((1, size)), np.zeros((0, size)), 1)
    index.sample = index.turned(vectors)
    lists = int(min(MOST_LISTS, max(1, entries // LIST_ROWS), max(1, len(vectors) // 16)))
    centers = index.sample[rng.choice(len(vectors), lists, replace=False)]
    for _ in range(8):
        own = _distances(index.sample, centers).argmin(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, index.sample)
        counts = np.bincount(own, minlength=lists)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    index.centers = centers
    # probes that reach the recall on the sample itself
    own = index.nearest_list(index.sample)
    trials = rng.choice(len(vectors), min(TRIALS, len(vectors)), replace=False)
    queries = index.turned(vectors[trials], query=True)
    best = np.argsort(_distances(queries, index.sample), axis=1)[:, : k + 1]
    order = np.argsort(np.argsort(_distances(queries, centers), axis=1), axis=1)
    depth = np.sort(np.take_along_axis(order, own[best], axis=1).ravel())
    index.probes = int(depth[min(len(depth) - 1, int(np.ceil(RECALL * len(depth))))]) + 1
    return index


def scan(
    queries: np.ndarray, limits: np.ndarray, entries: np.ndarray, columns: int = COLUMNS
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of query and entry whose partial distances pass every test (turned vectors)."""
    size = entries.shape[1]
    step = max(1, PAIRS_AT_ONCE // max(1, len(entries)))
    left, right = [], []
    for at in range(0, len(queries), step):
        some, limit = queries[at : at + step], limits[at : at + step]
        partial = _distances(some[:, :columns], entries[:, :columns])
        q, e = np.nonzero(partial <= (limit * _share(columns, size))[:, None])
        so_far = partial[q, e]
        for start in range(columns, size, columns):
            stop = min(size, start + columns)
            difference = some[q, start:stop] - entries[e, start:stop]
            so_far = so_far + np.einsum("ij,ij->i", difference, difference)
            keep = so_far <= limit[q] * _share(stop, size)
            q, e, so_far = q[keep], e[keep], so_far[keep]
        left.append(q + at)
        right.append(e)
    return np.concatenate(left), np.concatenate(right)


def _share(done: int, size: int) -> float:
    """The part of a limit that ``done`` of ``size`` coordinates may take."""
    return 1 + 1e-9 if done >= size else done / size * (1 + DEVIATIONS / np.sqrt(done)) ** 2


def matrix(column: Iterable[bytes]) -> np.ndarray:
    rows = list(column)
    return np.frombuffer(b"".join(rows), dtype="<f8").reshape(len(rows), -1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vec`` (array of double) of the vectors that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").alias("id"), v.alias("vec")).filter(F.col("id").isNotNull())
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec").isNotNull() & whole & F.exists("vec", lambda x: x != 0))


def _as_bytes(rows: DataFrame, kinds: str) -> DataFrame:
    """The array column ``vec`` as the bytes of its doubles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("vec")
            data = [np.array(v, dtype="<f8").tobytes() for v in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(run, kinds)


def search(
    vectors: DataFrame, queries_modulus: int, k: int = K, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row whose key is
    divisible by ``queries_modulus``, the row itself left out.

    Vectors of another length than most take no part, nor do null, zero or
    non-finite ones or rows without a key. A key that repeats with different
    vectors is as many candidates. Equal scores go to the smaller key.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    sizes = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"))
    size = sizes.orderBy(F.desc("n"), "size").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vec") == size["size"])
    first = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    copies = rows.withColumn("_nth", first).filter(F.col("_nth") <= k + 1)
    entries = copies.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = entries.select(F.col("ids")[0].alias("entry"), "vec", "ids")
    # equal smallest ids of different vectors would share an entry name
    entries = entries.withColumn("entry", F.struct("entry", F.xxhash64("vec").alias("h")))
    kinds = "entry struct<entry:long,h:long>, vec binary, ids array<long>"
    entries = store(_as_bytes(entries, kinds), "vectors")

    stats = entries.select(F.count("*").alias("n")).first()["n"]
    share = min(1.0, SAMPLE / stats)
    chosen = entries.filter(F.pmod(F.xxhash64("entry", F.lit(5)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    norm = rows.select(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("s")).first()["s"]
    sample = matrix(r["vec"] for r in chosen.select("vec").limit(2 * SAMPLE).collect())
    if not len(sample):
        sample = matrix(r["vec"] for r in entries.select("vec").limit(SAMPLE).collect())
    index = fit(sample, float(np.sqrt(norm)), stats, k)
    shared = spark.sparkContext.broadcast(index)

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = shared.value.nearest_list(shared.value.turned(matrix(batch.column(1).to_pylist())))
                columns = [pa.array(lists, pa.int32()), *batch.columns]
                yield pa.RecordBatch.from_arrays(columns, names=["list", *batch.schema.names])

    placed = store(entries.mapInArrow(listed, f"list int, {kinds}"), "listed")
    filled = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}

    copied = rows.filter(F.col("id") % queries_modulus == 0)
    # ids beyond the first copies still ask: find their entry by the vector
    askers = _as_bytes(copied.select("id", "vec"), "id long, vec binary")
    names = placed.select("entry", "vec")
    askers = store(askers.join(names, "vec").select("id", "entry"), "askers")
    asked = placed.join(askers.select("entry").distinct(), "entry", "left_semi")

    def probing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        counts = np.array([filled.get(i, 0) for i in range(len(index.centers))])
        for batch in batches:
            if not batch.num_rows:
                continue
            turned = index.turned(matrix(batch.column(1).to_pylist()), query=True)
            order = np.argsort(_distances(turned, index.centers), axis=1, kind="stable")
            # as many lists as fitted, or more until they hold enough
            enough = (np.cumsum(counts[order], axis=1) < 4 * (k + 1)).sum(axis=1) + 1
            probes = [o[: max(index.probes, n)].tolist() for o, n in zip(order, enough, strict=True)]
            names = ["query", "vec", "limit", "lists"]
            # twice as many as wanted, so that a few wrong rejections leave enough
            limits = pa.array(index.limit(turned, probes, 2 * (k + 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, limits, pa.array(probes, pa.list_(pa.int32()))], names=names
            )

    query_kinds = "query struct<entry:long,h:long>, vec binary, limit double, lists array<int>"
    probes = store(asked.select("entry", "vec").mapInArrow(probing, query_kinds), "probes")
    per_list = probes.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("n"))
    asks = {r["list"]: r["n"] for r in per_list.collect()}
    # both bounded by the number of lists
    deal = spark.createDataFrame(
        [(i, -(-n // BLOCK_ROWS), -(-asks.get(i, 0) // CHUNK_ROWS)) for i, n in filled.items()],
        "list int, blocks int, chunks int",
    ).filter("chunks > 0")
    deal = F.broadcast(deal)
    left = (
        placed.join(deal, "list")
        .withColumn("block", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("list", "block", "chunk", "entry", "vec")
    )
    right = (
        probes.select("query", "vec", "limit", F.explode("lists").alias("list"))
        .join(deal, "list")
        .withColumn("chunk", F.pmod(F.xxhash64("query", F.lit(3)), F.col("chunks")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("list", "block", "chunk", "query", "vec", "limit")
    )

    def meet(block: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "qh": [], "entry": [], "eh": [], "score": []}
        if len(block) and len(asking):
            index = shared.value
            x, q = matrix(block["vec"]), matrix(asking["vec"])
            i, j = scan(index.turned(q, query=True), asking["limit"].to_numpy(), index.turned(x))
            scores = np.einsum("ij,ij->i", q[i], x[j])
            order = np.lexsort((j, -scores, i))
            i, j, scores = i[order], j[order], scores[order]
            nth = np.arange(len(i)) - np.searchsorted(i, i)
            keep = nth < k + 1
            # equal scores at the end of a block's best are all kept
            last = np.full(len(q), -np.inf)
            np.maximum.at(last, i[nth == k], scores[nth == k])
            keep |= scores >= last[i]
            i, j = i[keep], j[keep]
            who, what = asking["query"].tolist(), block["entry"].tolist()
            out = {
                "query": [who[a]["entry"] for a in i], "qh": [who[a]["h"] for a in i],
                "entry": [what[b]["entry"] for b in j], "eh": [what[b]["h"] for b in j],
                "score": scores[keep],
            }
        return pd.DataFrame(out)

    keys = ["list", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    found = found.applyInPandas(meet, "query long, qh long, entry long, eh long, score double")
    found = found.select(
        F.struct(F.col("query").alias("entry"), F.col("qh").alias("h")).alias("query"),
        F.struct("entry", F.col("eh").alias("h")).alias("entry"),
        "score",
    )
    best = F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))
    found = store(found.withColumn("_nth", best).filter(F.col("_nth") <= k + 1).drop("_nth"), "found")
    every = found.join(placed.select("entry", "ids"), "entry").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    every = every.withColumn("_nth", nth).filter(F.col("_nth") <= k + 1).drop("_nth")
    answers = askers.select(F.col("id").alias("query_id"), F.col("entry").alias("query")).distinct()
    answers = answers.join(every, "query").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
