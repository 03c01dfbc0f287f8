"""Prefix tries of conversations, built as burst tries.

A turn is a 128-bit digest of its role and text. Equal conversations are one
sequence with a count. All sequences start in one container under the root. A
container of more than ``CONTAINER_ROWS`` turns is burst by its next turn ids, a
growing number of levels a round: its sequences are dealt to containers under the
new trie heads. Containers that fit are each sorted and swept by one task, which
makes their nodes. A container that holds a single sequence, however long, is a
chain and needs no sweep.

What a head's node reports is summed over the sequences below it. For that each
sequence owns the nodes whose smallest member it is, which are the last ones of
its path, and bytes are cumulated along paths.

Conversations are numbered by ranges of (conversation, turn), so one that holds
most rows is spread over tasks; only the turns of one burst round, one chunk of a
chain, or one container are ever brought together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.llm.common import batch_of, partitions_for, store

#: Turns of all sequences of a container that one task sweeps.
CONTAINER_ROWS = 2048
#: Levels burst in the first round; doubled each round up to the most.
LEVELS, MOST_LEVELS = 8, 256
#: Conversations whose ids are joined into one block before they are hashed.
BLOCK_IDS = 1 << 15
#: Turns of a chain that are summed together.
CHUNK = 4096
FAMILY, SHARED_MODULUS = 5, 9
ROOT = bytes(16)
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ender long"
)


def turn_table(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``c, p, id, bytes``: the turns of each conversation in order, from a written table.

    Null turn numbers come first, equal ones follow the order of their digests;
    null roles and texts are empty. Rows without a conversation id belong to none.
    """
    spark = conversations.sparkSession
    said, body = (F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in (role, text))
    whole = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, body)
    rows = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("c"),
        F.col(f"`{turn}`").alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("id"),
        F.octet_length(body).cast("long").alias("bytes"),
    ).filter("c is not null")
    by = ["c", "turn", "id", "tie"]
    sorted_rows = (
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(partitions_for(spark), *by)
        .sortWithinPartitions(*by)
    )
    placed = store(sorted_rows.select("c", "id", "bytes", F.monotonically_increasing_id().alias("at")), "turns")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("c", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    found = placed.join(starts, ["c", "part"])
    return store(found.select("c", (F.col("start") + F.col("at") - F.col("first")).alias("p"), "id", "bytes"), "turns")


def shared(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(SHARED_MODULUS))


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with the head of their family's first one: ``c, pos, id, bytes`` and ``c, len``."""
    sizes = store(turns.groupBy("c").agg(F.count("*").alias("n")), "conversations")
    first = sizes.select(F.col("c").alias("b"), F.col("n").alias("n_b"))
    base = F.col("c") - F.pmod("c", F.lit(FAMILY))
    h = shared(F.col("c"))
    taken = F.least(h, F.coalesce("n_b", F.lit(0)))
    convs = sizes.withColumn("b", base).join(first, "b", "left").select(
        "c", "b", taken.alias("taken"), (taken + F.greatest(F.col("n") - h, F.lit(0))).alias("len")
    )
    convs = store(convs, "rebuilt-sizes")
    own = turns.filter(F.col("p") >= h).join(convs.select("c", "taken"), "c")
    own = own.select("c", (F.col("taken") + F.col("p") - h).alias("pos"), "id", "bytes")
    # a family has at most FAMILY members and its head SHARED_MODULUS - 1 turns
    heads = turns.filter((F.pmod("c", F.lit(FAMILY)) == 0) & (F.col("p") < SHARED_MODULUS - 1))
    heads = heads.withColumnRenamed("c", "b")
    given = convs.filter("taken > 0").select("c", "b", "taken").join(heads, "b").filter("p < taken")
    rows = own.union(given.select("c", F.col("p").alias("pos"), "id", "bytes"))
    return store(rows, "rebuilt"), convs.select("c", "len")


def sequences(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct sequence: ``c`` (its smallest conversation), ``m`` (conversations),
    ``len, total`` (bytes) and ``ends`` (digest of the sorted ids)."""
    spark = rows.sparkSession
    sums = rows.groupBy("c").agg(
        F.bit_xor(F.xxhash64("pos", "id")).alias("s1"),
        F.bit_xor(F.xxhash64("id", "pos", F.lit(1))).alias("s2"),
        F.sum("bytes").alias("total"),
    )
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("s1", "s2", "total")]
    whole = store(convs.join(sums, "c", "left").select("c", "len", *zero), "sequence-sums")
    group = ["s1", "s2", "len", "total"]
    parts = partitions_for(spark)
    kinds = ", ".join(f"{g} long" for g in group)

    def batches_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return batch_of(schema, [list(c) for c in zip(*rows, strict=True)])

    block = pa.schema([*((g, pa.int64()) for g in group), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
    done = pa.schema(
        [(n, pa.int64()) for n in ("c", "m", "len", "total")] + [("ends", pa.string())]
    )

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, out = None, [], []

        def add() -> None:
            if ids:
                out.append((*now, ids[0], len(ids), ",".join(map(str, ids)).encode()))

        for batch in batches:
            for *key, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if key != now or len(ids) == BLOCK_IDS:
                    add()
                    now, ids = key, []
                ids.append(c)
            if len(out) > 2000:
                yield batches_of(out, block)
                out = []
        add()
        if out:
            yield batches_of(out, block)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, m, digest, out = None, None, 0, None, []

        def add() -> None:
            if now is not None:
                out.append((first, m, now[2], now[3], digest.hexdigest()))

        for batch in batches:
            for *key, start, n, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if key != now:
                    add()
                    now, first, m, digest = key, start, 0, hashlib.sha256()
                elif m:
                    digest.update(b",")
                digest.update(ids)
                m += n
            if len(out) > 2000:
                yield batches_of(out, done)
                out = []
        add()
        if out:
            yield batches_of(out, done)

    # the ids of a sequence that most conversations have are joined by many tasks,
    # the one that hashes them in order reads whole blocks
    ordered = whole.select(*group, "c").repartitionByRange(parts, *group, "c").sortWithinPartitions(*group, "c")
    blocks = store(ordered.mapInArrow(join, f"{kinds}, first long, n long, ids binary"), "sequence-ids")
    gathered = blocks.repartition(parts, *group).sortWithinPartitions(*group, "first")
    return store(gathered.mapInArrow(hashed, "c long, m long, len long, total long, ends string"), "sequences")


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of the levels below a container along each sequence."""
    names = ["c", "key", "parent", "depth", "upto", "bytes", "len", "origin"]
    binary = {"key", "parent"}
    schema = pa.schema([(n, pa.binary() if n in binary else pa.int64()) for n in names])
    for batch in batches:
        out: list[tuple] = []
        for c, key, depth, upto, size, turns in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            origin = depth
            for turn in turns:
                parent, key = key, hashlib.blake2b(key + turn["id"], digest_size=16).digest()
                depth, upto = depth + 1, upto + turn["bytes"]
                out.append((c, key, parent, depth, upto, turn["bytes"], size, origin))
        if out:
            yield batch_of(schema, [list(x) for x in zip(*out, strict=True)])


def burst(rows: DataFrame, seqs: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Trie heads and what is left in containers.

    ``c, key, parent, depth, upto, bytes, len``: each sequence under each head
    above it; ``c, key, depth, upto, single``: where its suffix lies, if any is left.
    """
    root = F.lit(ROOT)
    heads = seqs.select(
        "c", root.alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("bytes"), "len",
    )
    active = seqs.filter("len > 0").select(
        "c", root.alias("key"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("upto"), "len"
    )
    left, levels = None, LEVELS
    columns = ["c", "key", "parent", "depth", "upto", "bytes", "len"]
    while not active.isEmpty():
        window = rows.join(active, "c").filter((F.col("pos") >= F.col("depth")) & (F.col("pos") < F.col("depth") + levels))
        lists = window.groupBy("c", "key", "depth", "upto", "len").agg(
            F.array_sort(F.collect_list(F.struct("pos", "id", "bytes"))).alias("turns")
        )
        found = lists.mapInArrow(
            _chain, "c long, key binary, parent binary, depth long, upto long, bytes long, len long, origin long"
        )
        found = store(found, "levels")
        rest = F.col("len") - F.col("depth")
        sizes = found.groupBy("key").agg(F.count("*").alias("k"), F.sum(rest).alias("size"))
        big = store(sizes.filter((F.col("k") > 1) & (F.col("size") > most)).select("key"), "oversized")
        above = big.select(F.col("key").alias("parent"), F.lit(True).alias("parent_big"))
        marked = (
            found.join(above, "parent", "left")
            .filter((F.col("depth") == F.col("origin") + 1) | F.col("parent_big"))
            .join(big.withColumn("is_big", F.lit(True)), "key", "left")
            .join(sizes.select("key", (F.col("k") == 1).alias("single")), "key")
        )
        marked = store(marked.select(*columns, "origin", "single", F.coalesce("is_big", F.lit(False)).alias("is_big")), "heads")
        heads = heads.union(marked.select(*columns))
        here = marked.filter("depth < len")
        done = here.filter("not is_big").select("c", "key", "depth", "upto", "single")
        left = done if left is None else left.union(done)
        active = here.filter(F.col("is_big") & (F.col("depth") == F.col("origin") + levels)).select(
            "c", "key", "depth", "upto", "len"
        )
        levels = min(2 * levels, MOST_LEVELS)
    if left is None:
        left = heads.filter("false").select("c", "key", "depth", "upto", F.lit(True).alias("single"))
    return heads, left


def sweep(sequences: list[tuple[int, int, bytes, list[int]]], depth: int, head: int) -> tuple[list, dict, int]:
    """The nodes of one container from its sorted sequences.

    ``sequences`` has ``c, m``, joined turn ids and bytes of each. Gives the nodes
    below the head, ``c: (own bytes, is a leaf)`` and the number of top nodes.
    """
    nodes: list[list] = []  # parent, depth, smallest, members, children, leaves, saved, bytes, ender
    path: list[int] = []
    ends, tops, last = {}, 0, b""

    def close() -> None:
        node = nodes[path.pop()]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[7]
        if path:
            up = nodes[path[-1]]
            up[2] = min(up[2], node[2])
            up[3] += node[3]
            up[5] += node[5]
            up[6] += node[6]

    for c, m, ids, sizes in sorted(sequences, key=lambda s: s[2]):
        common, most = 0, min(len(ids), len(last)) // 16
        while common < most and ids[16 * common : 16 * common + 16] == last[16 * common : 16 * common + 16]:
            common += 1
        while len(path) > common:
            close()
        for at in range(common, len(sizes)):
            if path:
                nodes[path[-1]][4] += 1
            else:
                tops += 1
            nodes.append([path[-1] if path else -1, depth + at + 1, c, 0, 0, 0, 0, sizes[at], None])
            path.append(len(nodes) - 1)
        # a node opened by another sequence has members already counted below it
        top = nodes[path[-1]]
        top[2], top[3], top[8] = min(top[2], c), top[3] + m, c
        ends[c] = path[-1]
        last = ids
    while path:
        close()
    own = dict.fromkeys(ends, 0)
    for node in nodes:
        own[node[2]] += node[7]
    facts = {c: (own[c], nodes[i][4] == 0) for c, i in ends.items()}
    out = [
        (n[2], n[1], head if n[0] < 0 else nodes[n[0]][2], n[3], n[4], n[5], n[6], n[8]) for n in nodes
    ]
    return out, facts, tops


def _sweeps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, facts and top counts of containers whose rows follow each other."""
    names = [f.split()[0] for f in NODE.split(", ")] + ["key", "own", "leaf"]
    kinds = {"key": pa.binary(), "leaf": pa.bool_()}
    schema = pa.schema([("kind", pa.string())] + [(n, kinds.get(n, pa.int64())) for n in names])
    now, held, out = None, {}, []

    def flush() -> None:
        if now is None:
            return
        key, head, depth = now
        listed = [(c, m, b"".join(ids), sizes) for c, (m, ids, sizes) in held.items()]
        nodes, facts, tops = sweep(listed, depth, head)
        nothing = (None,) * len(nodes[0])
        out.extend(("node", *n, None, None, None) for n in nodes)
        out.extend(("fact", c, *nothing[1:], None, own, leaf) for c, (own, leaf) in facts.items())
        out.append(("head", None, None, None, None, tops, None, None, None, key, None, None))

    for batch in batches:
        for key, head, depth, c, m, ident, size in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if now is None or key != now[0]:
                flush()
                now, held = (key, head, depth), {}
            entry = held.setdefault(c, (m, [], []))
            entry[1].append(ident)
            entry[2].append(size)
        if len(out) > 4096:
            yield batch_of(schema, [list(x) for x in zip(*out, strict=True)])
            out = []
    flush()
    if out:
        yield batch_of(schema, [list(x) for x in zip(*out, strict=True)])


def _chains(suffixes: DataFrame) -> DataFrame:
    """The nodes of containers that hold one sequence: ``suffixes`` has
    ``c, head, m, depth, len, pos, bytes``."""
    rows = store(suffixes.withColumn("chunk", F.expr(f"pos div {CHUNK}")), "chains")
    sums = rows.groupBy("c", "chunk").agg(F.sum("bytes").alias("sum"))
    after = Window.partitionBy("c").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("c", "chunk", F.coalesce(F.sum("sum").over(after), F.lit(0)).alias("later"))
    down = Window.partitionBy("c", "chunk").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    below = F.sum("bytes").over(down)
    last = F.col("pos") + 1 == F.col("len")
    return rows.withColumn("below", below).join(sums, ["c", "chunk"]).select(
        F.col("c").alias("conv_id"),
        (F.col("pos") + 1).alias("depth"),
        F.when(F.col("pos") == F.col("depth"), F.col("head")).otherwise(F.col("c")).alias("parent_conv_id"),
        F.col("m").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("m") - 1) * (F.col("below") + F.col("later"))).alias("saved_tokens"),
        F.when(last, F.col("c")).alias("ender"),
    )


def build(conversations: DataFrame, most: int = CONTAINER_ROWS, **columns: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Rows that
    repeat are turns of their own. A table without conversations has no node, not
    even a root. Further columns are not read.
    """
    rows, convs = rebuild(turn_table(conversations, **columns))
    seqs = sequences(rows, convs)
    rows = store(rows.join(seqs.select("c"), "c", "left_semi"), "distinct-rows")
    heads, left = burst(rows, seqs, most)
    heads = heads.withColumn("ended", F.col("depth") == F.col("len"))
    least = store(heads.groupBy("key").agg(F.min("c").alias("head"), F.count("*").alias("k")), "head-ids")

    placed = left.join(least.select("key", "head"), "key").join(seqs.select("c", "m", "len"), "c")
    placed = store(placed, "placed")
    suffixes = rows.join(placed, "c").filter(F.col("pos") >= F.col("depth"))
    many = suffixes.filter("not single").select("key", "head", "depth", "c", "m", "id", "bytes", "pos")
    parts = partitions_for(rows.sparkSession)
    many = many.repartition(parts, "key").sortWithinPartitions("key", "c", "pos").drop("pos")
    swept = store(
        many.mapInArrow(_sweeps, f"kind string, {NODE}, key binary, own long, leaf boolean"), "swept"
    )
    single = suffixes.filter("single").select("c", "head", "m", "depth", "len", "pos", "bytes")
    names = [f.split()[0] for f in NODE.split(", ")]
    below = swept.filter("kind = 'node'").select(*names).union(_chains(single))

    # what each sequence owns of the paths, and whether it ends in a leaf
    swept_facts = swept.filter("kind = 'fact'").select(F.col("conv_id").alias("c"), "own", "leaf")
    chained = placed.filter("single").join(seqs.select("c", "total"), "c").select(
        "c", (F.col("total") - F.col("upto")).alias("own"), F.lit(True).alias("leaf")
    )
    known = heads.join(least, "key")
    # the last head of which it is not the smallest member, its own bytes begin there
    above = known.groupBy("c").agg(
        F.max(F.when(F.col("c") != F.col("head"), F.struct("depth", "upto"))).alias("other"),
        F.max(F.struct("depth", (F.col("c") == F.col("head")).alias("owner"))).alias("lowest"),
        F.max(F.col("ended") & (F.col("k") == 1)).alias("alone"),
    )
    facts = (
        seqs.select("c", "m", "total")
        .join(above, "c")
        .join(swept_facts.union(chained), "c", "left")
        .select(
            "c",
            "m",
            "total",
            F.when(F.col("lowest.owner"), F.col("total") - F.coalesce("other.upto", F.lit(0)))
            .otherwise(F.coalesce("own", F.lit(0)))
            .alias("own"),
            F.coalesce("leaf", "alone").cast("long").alias("leaf"),
        )
    )
    facts = store(facts, "sequence-facts")

    joined = heads.join(facts, "c")
    first = F.min(F.struct("c", "own", "total"))
    sums = joined.groupBy("key").agg(
        first.alias("least"),
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first(F.col("upto") - F.col("bytes")).alias("before"),
        F.sum("m").alias("n_convs"),
        F.sum(F.col("m") * F.col("total")).alias("weighted"),
        F.sum("own").alias("owned"),
        F.sum("leaf").alias("n_leaves"),
        F.max(F.when(F.col("ended"), F.col("c"))).alias("ender"),
    )
    sums = store(sums, "head-sums")
    tops = swept.filter("kind = 'head'").select("key", F.col("n_children").alias("n"))
    chain_tops = placed.filter("single").select("key", F.lit(1).cast("long").alias("n"))
    kids = sums.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n"))
    children = kids.union(tops).union(chain_tops)
    # a path's bytes once a member, less once a node
    saved = (F.col("weighted") - F.col("n_convs") * F.col("before")) - (
        F.col("owned") - F.col("least.own") + F.col("least.total") - F.col("before")
    )
    up = least.select(F.col("key").alias("parent"), F.col("head").alias("parent_conv_id"))
    top = sums.join(children, "key", "left").join(up, "parent", "left").select(
        F.col("least.c").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
        F.coalesce("n", F.lit(0)).alias("n_children"), "n_leaves", saved.alias("saved_tokens"), "ender",
    )
    nodes = top.select(*names).union(below.select(*names))
    shown = names[:-1]
    ended = nodes.filter("ender is not null").join(seqs.select(F.col("c").alias("ender"), "ends"), "ender")
    inner = nodes.filter("ender is null").select(*shown, F.lit(EMPTY).alias("ends_sha256"))
    return inner.union(ended.select(*shown, F.col("ends").alias("ends_sha256")))
